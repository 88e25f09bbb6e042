"""Secrets in texts: fixed patterns, and runs that look drawn at random.

Two Markov models of characters, one of random strings and one of ordinary
identifiers, are counted over labelled samples. A run of identifier characters is
reported where the log-likelihood ratio of its transitions speaks for the random model.
DataFrame functions only.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values: (kind, pattern, group whose length counts, its least length), in the order of the report.
BASE_KINDS = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
)
# Runs shorter than the least length fail in any case; asked for in the pattern, they are
# never put into an array. A run is matched whole, so no other match takes their place.
_SEARCHED = {"access": r"AKIA[A-Z0-9]{14,}", "hex": r"[0-9a-f]{16,}"}
RANDOM_KIND = "random"

ALPHABET = "+-/0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz"
RUN = "[A-Za-z0-9+/_-]"
# Runs of at least this length are judged; the whole ratio and its mean over the transitions
# (natural logarithms) must reach these values.
LEAST_CHARS = 16
LEAST_RATIO = 12.0
LEAST_MEAN = 1.2
# Weights are whole thousandths, so that sums do not depend on their order.
UNIT = 1000
# Part of the random model that gives every character the same chance.
EVEN_SHARE = 0.5
BLOCK = 256


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once for several uses inside ``body``."""
    return F.transform(F.array(value), body).getItem(0)


def running_sums(steps: Column) -> Column:
    """Sums of an array up to each element: within blocks, on top of the sums of the
    blocks before, so a long array is not copied for each of its elements."""
    total = lambda part: F.aggregate(part, F.lit(0).cast("long"), lambda acc, x: acc + x)
    none = F.array().cast("array<bigint>")

    def summed(values: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int"))
        blocks = F.transform(starts, lambda b: F.slice(values, b * BLOCK + 1, F.lit(BLOCK)))
        return _let(blocks, lambda bs: _let(F.transform(bs, total), lambda sums: F.flatten(F.transform(
            bs, lambda block, i: F.aggregate(
                block, F.struct(total(F.slice(sums, F.lit(1), i)).alias("at"), none.alias("sums")),
                lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.array_append(acc["sums"], acc["at"] + x).alias("sums")),
                lambda acc: acc["sums"])))))

    return _let(steps, lambda values: F.when(F.size(values) > 0, summed(values)).otherwise(none))


def located(text: Column, found: Column, value: Column, pattern: str, kind: str, least: int) -> Column:
    """Matches as ``(start, rank, end, kind, value, whole)``, in code points: what lies between
    them and their own lengths add up to their places. ``found`` holds the matches, ``value``
    the parts whose length must reach ``least``."""
    rank = ([name for name, *_ in BASE_KINDS] + [RANDOM_KIND]).index(kind)
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    ends = running_sums(F.zip_with(gaps, found, lambda gap, match: (F.length(gap) + F.length(match)).cast("long")))
    every = F.transform(F.arrays_zip(ends.alias("end"), found.alias("whole"), value.alias("value")), lambda m: F.struct(
        (m["end"] - F.length(m["whole"])).alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"),
        F.lit(kind).alias("kind"), m["value"].alias("value"), m["whole"].alias("whole")))
    return F.when(F.size(found) > 0, F.filter(every, lambda m: F.length(m["value"]) >= least)).otherwise(
        F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string,value:string,whole:string>>"))


def blanked(text: Column, pattern: str, group: int, least: int) -> Column:
    """The text with blanks in place of the matches that count, so that places stay."""
    whole, value = (F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in (0, group))
    shown = F.zip_with(whole, value, lambda w, v: F.when(F.length(v) >= least, F.repeat(F.lit(" "), F.length(w))).otherwise(w))
    parts = F.zip_with(F.split(text, pattern, -1), shown, lambda gap, w: F.concat(gap, F.coalesce(w, F.lit(""))))
    return F.array_join(parts, "")


def with_base(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id``, the base spans as ``base`` and, as ``rest``, the text with these blanked.

    A text is searched for a kind once; places, values and blanks are only worked out
    where something was found.
    """
    text, none = F.col("text"), F.array().cast("array<string>")
    lowered = F.lower(text)
    worth = {"assign": lowered.contains("passw") | lowered.contains("secret") | lowered.contains("token")
                       | lowered.contains("apikey") | lowered.contains("api_key"), "access": text.contains("AKIA")}
    df = docs.select(F.col(f"`{id_column}`").alias("id"), F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"))
    found = {kind: F.regexp_extract_all(text, F.lit(_SEARCHED.get(kind, pattern)), F.lit(0)) for kind, pattern, *_ in BASE_KINDS}
    df = df.withColumns({f"_{kind}": F.when(worth[kind], all_of).otherwise(none) if kind in worth else all_of
                         for kind, all_of in found.items()})
    spans, rest = [], text
    for kind, pattern, group, least in BASE_KINDS:
        pattern, hits = _SEARCHED.get(kind, pattern), F.col(f"_{kind}")
        value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
        spans.append(located(text, hits, value, pattern, kind, least))
        df = df.withColumn("rest", F.when(F.size(hits) > 0, blanked(rest, pattern, group, least)).otherwise(rest))
        rest = F.col("rest")
    return df.select("id", F.concat(*spans).alias("base"), "rest")


def samples(scanned: DataFrame) -> DataFrame:
    """Labelled samples ``(sample, random)`` of a scanned table: values of its base spans
    are random, everything beside them is ordinary."""
    values = F.array_join(F.transform("base", lambda m: m["value"]), " ")
    both = F.array(F.struct(F.col("rest").alias("sample"), F.lit(False).alias("random")),
                   F.struct(values.alias("sample"), F.lit(True).alias("random")))
    return scanned.select(F.inline(both)).filter("sample != ''")


@dataclass(frozen=True)
class Model:
    """Log-likelihood ratios of all transitions, in thousandths, row by row of ``ALPHABET``."""
    weights: tuple[int, ...]

    def ratio(self, run: Column) -> Column:
        """Summed ratio of a run of alphabet characters, in thousandths."""
        table = F.from_json(F.lit(json.dumps(self.weights)), "array<bigint>")
        pairs = F.regexp_extract_all(run, F.lit(f"(?=({RUN}{{2}}))"), F.lit(1))
        place = lambda pair, at: F.instr(F.lit(ALPHABET), F.substring(pair, at, 1)) - 1
        return F.aggregate(pairs, F.lit(0).cast("long"),
                           lambda acc, pair: acc + F.get(table, place(pair, 1) * len(ALPHABET) + place(pair, 2)))


def fit(labelled: DataFrame) -> Model:
    """Both Markov models from samples ``(sample, random)``, all of them.

    Transitions are counted in the tasks; at most one row for each pair of characters
    and label reaches the driver. Half of the random model is what its samples show, half
    any character with the same chance, as samples never show all alphabets that keys
    are drawn from; the ordinary model counts each transition once more than it is
    seen. Null and empty samples have none; without any sample all ratios are 0.
    """
    pair = F.explode(F.regexp_extract_all("sample", F.lit(f"(?=({RUN}{{2}}))"), F.lit(1)))
    seen = labelled.select("random", pair.alias("pair")).groupBy("random", "pair").count().collect()
    counts: Mapping[tuple[bool, str], int] = {(row["random"], row["pair"]): row["count"] for row in seen}
    even = 1 / len(ALPHABET)
    weights = []
    for a in ALPHABET:
        random, ordinary = ([counts.get((label, a + b), 0) for b in ALPHABET] for label in (True, False))
        drawn, used = sum(random), sum(ordinary) + len(ALPHABET)
        weights += [round(UNIT * (math.log((n / drawn if drawn else even) * (1 - EVEN_SHARE) + even * EVEN_SHARE) - math.log((m + 1) / used)))
                    for n, m in zip(random, ordinary)]
    return Model(tuple(weights))


def find_secrets(docs: DataFrame, model: Model | None = None, id_column: str = "doc_id", text_column: str = "text",
                 least_chars: int = LEAST_CHARS, least_ratio: float = LEAST_RATIO, least_mean: float = LEAST_MEAN) -> DataFrame:
    """Id and ``secrets``, an array of ``(start, rank, end, kind, value, whole)`` by start.

    Kinds are those of ``BASE_KINDS`` and ``random``: runs beside base spans that the
    models hold for random. Without a ``model``, one is fitted on the table itself: two
    passes over the texts and no shuffle but of transition counts. One row for every row
    of the input; null texts are empty and have no spans; equal rows give equal rows;
    a long text is one row with arrays as long as its matches. An empty table gives an
    empty one. Other columns of the input are not read.
    """
    scanned = with_base(docs, id_column, text_column)
    model = model or fit(samples(scanned))

    def drawn(run: Column) -> Column:
        bar = F.greatest(F.lit(round(least_ratio * UNIT)), round(least_mean * UNIT) * (F.length(run) - 1))
        return model.ratio(run) >= bar

    pattern = f"(?<!{RUN}){RUN}{{{least_chars},}}"
    found = scanned.withColumn("_runs", F.regexp_extract_all("rest", F.lit(pattern), F.lit(0)))
    runs = located(F.col("rest"), F.col("_runs"), F.col("_runs"), pattern, RANDOM_KIND, least_chars)
    both = F.concat("base", F.filter(runs, lambda m: drawn(m["whole"])))
    return found.select(F.col("id").alias(id_column), F.sort_array(both).alias("secrets"))


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda m: F.concat_ws(":", m["kind"], m["start"].cast("string"), m["end"].cast("string"))), ",")


def report(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, digest of the base spans and all spans as text."""
    count = lambda kind: F.size(F.filter("secrets", lambda m: m["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = listed(F.filter("secrets", lambda m: m["kind"] != RANDOM_KIND))
    return found.select(*[c for c in found.columns if c != "secrets"], *[count(kind) for kind, *_ in BASE_KINDS], F.sha2(base, 256).alias("base_sha256"),
                        listed(F.col("secrets")).alias("spans"))
