"""Raw change events -> normalised edit events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.codec import parse_json_or_skip
from tidemark.functions.labels import namespace_label, user_type_label
from tidemark.functions.times import epoch_seconds_to_text
from tidemark.schemas import EDIT_TYPE, MESSAGE_KIND, RAW_EDIT


def parse_raw_edits(df: DataFrame, text_col: str = "value", on_error: str = "skip",
                    kind_col: str | None = None) -> DataFrame:
    """Decode raw event text by the declared schema.

    With ``kind_col`` only event-stream records of kind ``message`` are
    read.  ``on_error="skip"`` drops records that are not JSON (and null
    records); ``"fail"`` stops the job on the first one.
    """
    if kind_col is not None:
        df = df.where(F.col(kind_col) == F.lit(MESSAGE_KIND))
    if on_error == "fail":
        parsed = F.from_json(F.col(text_col).cast("string"), RAW_EDIT, {"mode": "FAILFAST"})
        return df.select(parsed.alias("_e")).select("_e.*")
    if on_error != "skip":
        raise ValueError(f"on_error must be 'skip' or 'fail', not {on_error!r}")
    return parse_json_or_skip(df, text_col, RAW_EDIT)


def normalise_edits(raw: DataFrame) -> DataFrame:
    """Keep ``type == "edit"`` and reshape to the 7-field event."""
    return raw.where(F.col("type") == F.lit(EDIT_TYPE)).select(
        F.col("id"),
        F.col("meta.domain").alias("domain"),
        namespace_label("namespace").alias("namespace"),
        F.col("title"),
        epoch_seconds_to_text("timestamp").alias("createTime"),
        F.col("user").alias("user_name"),
        user_type_label("bot").alias("user_type"),
    )


def edit_days(raw: DataFrame) -> DataFrame:
    """Q5: domain and UTC day of the edits, straight from the parsed record:
    what a daily count needs, without formatting the time and reading it
    again."""
    day = F.to_date(F.timestamp_seconds(F.col("timestamp")))
    return raw.where(F.col("type") == F.lit(EDIT_TYPE)).select(F.col("meta.domain").alias("domain"), day.alias("day"))
