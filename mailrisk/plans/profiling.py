"""All profiling tables of a canonical mail table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from mailrisk.operators import profile
from mailrisk.operators.standardize import MAIL_COLUMNS
from mailrisk.sources.tables import load_for_profiling


def profile_mails(mails: DataFrame) -> dict[str, DataFrame]:
    """Independent aggregations over one loaded table; no source table without sources."""
    loaded = load_for_profiling(mails)
    columns = tuple(name for name in MAIL_COLUMNS if name in loaded.columns)
    tables = {
        "class_distribution": profile.class_distribution(loaded),
        "text_length_distribution": profile.length_histogram(loaded),
        "missing_values": profile.missing_values(loaded, columns),
        "duplicate_statistics": profile.duplicate_statistics(loaded),
        "top_terms_by_class": profile.top_terms_by_class(loaded),
    }
    if "source_file" in loaded.columns:
        tables["dataset_source_distribution"] = profile.source_distribution(loaded)
    return tables
