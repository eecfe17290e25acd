"""Transaction ingestion and risk profiling as Spark DataFrame operators."""

from riskframe.operators.categories import (
    category_counts,
    distinct_counts,
    label_by_category,
    most_common,
    value_counts,
)
from riskframe.operators.dedupe import duplicate_counts, first_per_key
from riskframe.operators.leakage import (
    constant_features,
    high_correlations,
    label_correlations,
    majority_positive_categories,
    near_duplicates,
)
from riskframe.operators.mappings import (
    ATM,
    DEFAULT_MAPPINGS,
    ONLINE,
    POS,
    SourceMapping,
    register,
    renaming,
)
from riskframe.operators.numeric import (
    extreme_values,
    iqr_outliers,
    label_by_numeric,
    numeric_summary,
    quartiles,
)
from riskframe.operators.profile import (
    class_balance,
    class_counts,
    column_scan,
    column_stats,
    constant_columns,
    dataset_size,
    duplicate_rows,
    missing_values,
    negative_values,
    overview,
    quality_warnings,
)
from riskframe.operators.roles import classify_columns, temporal_columns
from riskframe.operators.temporal import period_counts, period_rates, period_shifts, row_order
from riskframe.operators.validation import (
    event_time,
    reject_field_counts,
    reject_metrics,
    rejected_records,
    valid_records,
    validate,
)
from riskframe.plans.findings import leakage_findings
from riskframe.plans.ingest import IngestResult, Source, ingest, ingest_folder
from riskframe.plans.run_all import run_all
from riskframe.shipping import ship
from riskframe.sources.files import (
    csv_columns,
    discover_csv,
    head,
    read_text_csv,
    read_typed_csv,
    row_count,
    with_row_index,
)
from riskframe.sources.routing import detect_mapping, route, routed_files
from riskframe.sources.sinks import canonical_frame, write_csv, write_parquet, write_rejects
from riskframe.streaming.ordered import OrderedIngest

__all__ = [name for name in dir() if not name.startswith("_")]
