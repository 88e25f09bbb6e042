"""Class probabilities of a model as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadlens.functions.lexicon import score_struct
from threadlens.scale import let

LABELS = ("negative", "neutral", "positive")


def softmax(logits: Column) -> Column:
    def scaled(powers: Column) -> Column:
        total = F.aggregate(powers, F.lit(0.0), lambda acc, p: acc + p)
        return let(total, lambda t: F.transform(powers, lambda p: p / t))

    shifted = let(F.array_max(logits), lambda top: F.transform(logits, lambda x: F.exp(x - top)))
    return let(shifted, scaled)


def argmax_label(scores: Column, labels: Sequence[str] = LABELS) -> Column:
    """Label of the highest score, the first one on ties."""
    names = F.array(*[F.lit(name) for name in labels])
    return F.get(names, (F.array_position(scores, F.array_max(scores)) - 1).cast("int"))


def failed_score(error: Column) -> Column:
    """What a text gets whose batch failed: neutral, compound 0, no class scores."""
    nothing = F.lit(None).cast("double")
    return score_struct(nothing, nothing, nothing, F.lit(0.0), F.lit("neutral"), error)


def model_score(logits: Column, error: Column | None = None,
                labels: Sequence[str] = LABELS) -> Column:
    """Score struct from logits in label order."""
    labels = tuple(labels)

    def from_probabilities(p: Column) -> Column:
        share = {name: F.get(p, F.lit(i)) for i, name in enumerate(labels)}
        of = lambda name: share.get(name, F.lit(None).cast("double"))
        both = "negative" in share and "positive" in share
        compound = of("positive") - of("negative") if both else F.lit(0.0)
        return score_struct(of("negative"), of("neutral"), of("positive"), compound,
                            argmax_label(p, labels))

    scored = let(softmax(logits), from_probabilities)
    if error is None:
        return scored
    return F.when(error.isNotNull() | logits.isNull(), failed_score(error)).otherwise(scored)


def overall_model(title: Column, text: Column, title_weight: float = 0.3) -> Column:
    """Weighted mean of title and text scores, labelled by the highest class.
    Where either part failed the class scores are unknown: neutral with the error."""

    def combined(pair: Column) -> Column:
        first, second = pair["title"], pair["text"]
        mix = lambda name: first[name] * title_weight + second[name] * (1 - title_weight)
        error = F.coalesce(first["error"], second["error"])
        best = argmax_label(F.array(mix("neg"), mix("neu"), mix("pos")))
        label = F.when(error.isNull(), best).otherwise(F.lit("neutral"))
        return score_struct(mix("neg"), mix("neu"), mix("pos"), mix("compound"), label, error)

    return let(F.struct(title.alias("title"), text.alias("text")), combined)
