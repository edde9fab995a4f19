"""Score pasted mails as they arrive: the batch operators on a stream.

Scoring keeps no state, so a micro-batch is one map stage without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mailrisk.functions.text import strip
from mailrisk.operators.explain import explain_mails, score_mails
from mailrisk.operators.features import model_input, parse_mail_table
from mailrisk.operators.linear import LinearModel

SCORE_COLUMNS = ("predicted_label", "prediction", "phishing_probability", "risk_score", "risk_level")
REJECTED = "Email text cannot be empty."


def pasted_vectors(texts: DataFrame, text: str, model: LinearModel, keys: tuple[str, ...]) -> DataFrame:
    """Parse pasted mails and build the inputs of the model; ``text`` is kept."""
    parsed = parse_mail_table(texts.withColumn("_pasted", F.col(text)), "_pasted")
    inputs = model_input(parsed, keep=(*keys, text))
    return model.terms.vectorize(inputs)


def score_pasted(
    texts: DataFrame, text: str, model: LinearModel, keys: tuple[str, ...], explain: bool = False
) -> DataFrame:
    """Score pasted mails (batch or stream); blank mails get ``error`` instead."""
    blank = strip(F.coalesce(F.col(text), F.lit(""))) == ""
    scored = score_mails(pasted_vectors(texts, text, model, keys), model)
    if explain:
        scored = explain_mails(scored, model)
    outputs = [*SCORE_COLUMNS, *(("top_phishing_terms", "metadata_contributions") if explain else ())]
    return scored.select(
        *keys,
        *(F.when(~blank, F.col(name)).alias(name) for name in outputs),
        F.when(blank, F.lit(REJECTED)).alias("error"),
    )


def start_scoring(
    texts: DataFrame, text: str, model: LinearModel, keys: tuple[str, ...], output: str, checkpoint: str
) -> StreamingQuery:
    """Score all mails available in a stream into a parquet folder, then stop."""
    return (
        score_pasted(texts, text, model, keys)
        .writeStream.format("parquet").outputMode("append")
        .option("path", output).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
