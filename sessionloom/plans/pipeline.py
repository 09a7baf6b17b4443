"""parse -> redact -> clean -> evaluate -> filter in one go."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.operators.clean import clean
from sessionloom.operators.format import format_for_training, keep_scored
from sessionloom.operators.redact import Anonymizer, redact
from sessionloom.operators.score import evaluate
from sessionloom.session import written


class Stages(dict):
    """Frames by stage, and what the stages did in numbers."""

    def report(self) -> dict[str, int]:
        """redacted, removed, good, maybe, bad, records, survivors: single columns of written tables."""
        redacted = self.counted.agg(F.coalesce(F.sum("n_redacted"), F.lit(0)).alias("redacted")).first()
        return redacted.asDict() | score_report(self["scored"], self.min_score)


def score_report(scored: DataFrame, min_score: float) -> dict[str, int]:
    count = lambda c: F.count(F.when(c, 1))
    labels = [count(F.col("label") == x).alias(x) for x in ("good", "maybe", "bad")]
    removed = F.coalesce(F.sum("_cleaned_stats.removed_tool_results"), F.lit(0)).alias("removed")
    return scored.agg(removed, *labels, F.count("*").alias("records"), count(F.coalesce("score", F.lit(0.0)) >= min_score).alias("survivors")).first().asDict()


def stages(records: DataFrame, min_score: float = 0.5, min_turns: int = 2, min_tokens: int = 1000, anonymizer: Anonymizer | None = None, wordlist: str | None = None) -> Stages:
    """The frames after each stage by name.

    The redacted and the scored conversations are written once to shared storage: later
    stages, and callers that keep several of them, then never repeat the work before, and
    the filter's predicate isn't planned together with all that made the score.
    """
    out = Stages(raw=records)
    out.min_score = min_score
    out.counted = written(redact(records, anonymizer, wordlist), "redacted")
    out["redacted"] = out.counted.drop("n_redacted")
    out["cleaned"] = clean(out["redacted"])
    out["scored"] = written(evaluate(out["cleaned"], min_turns, min_tokens), "scored")
    out["final"] = format_for_training(keep_scored(out["scored"], min_score))
    return out
