"""Explicit schemas of every table: types, required columns, defaults, layout."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from stratafold import fixed_values as fv

STRING, LONG, DOUBLE = T.StringType(), T.LongType(), T.DoubleType()
BOOLEAN, DATE, TIMESTAMP = T.BooleanType(), T.DateType(), T.TimestampType()

# markers for defaults that are computed when a row is written
DEFAULT_UUID = "uuid"
DEFAULT_NOW = "now"


@dataclass(frozen=True)
class TableSpec:
    """What a table holds and how it lies on disk."""

    name: str
    schema: T.StructType
    required: tuple[str, ...] = ()
    defaults: tuple[tuple[str, object], ...] = ()
    partition: str | None = None
    cluster: tuple[str, ...] = ()
    # columns whose hash deals the rows of a table without days into folders
    buckets: tuple[str, ...] = ()
    # an instant whose UTC day says in which folder a row lies
    day_of: str | None = None
    # condition of the rows that are kept a second time, apart, by partition
    apart: str | None = None
    # key by which others take in the rows that each write has changed
    feed: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return self.schema.names


def _schema(*columns: tuple) -> T.StructType:
    """Columns as (name, type) or (name, type, comment)."""
    return T.StructType(
        [T.StructField(c[0], c[1], True, {"comment": c[2]} if len(c) > 2 else None) for c in columns]
    )


ERROR_LOG = TableSpec(
    "pipeline_management/extraction_errors_v2",
    _schema(
        ("error_id", STRING), ("proceso", STRING), ("platform", STRING),
        ("parent_id", STRING), ("parent_tipo", STRING), ("child_id", STRING), ("child_tipo", STRING),
        ("entidad_id", STRING), ("entidad_tipo", STRING), ("tipo_error", STRING),
        ("mensaje_error", STRING), ("fecha_ejecucion", TIMESTAMP), ("intentos", LONG),
        ("resuelto", BOOLEAN), ("resuelto_at", TIMESTAMP),
    ),
    required=("proceso", "platform"),
    defaults=(("error_id", DEFAULT_UUID), ("fecha_ejecucion", DEFAULT_NOW), ("intentos", 1), ("resuelto", False)),
    day_of="fecha_ejecucion",
)

# The ledger lies by file day: the gate and each registration touch one day. Its open
# entries lie apart, so that a load does not read all days for the files to retry.
LOAD_LEDGER = TableSpec(
    "pipeline_management/load_control",
    _schema(
        ("load_id", STRING), ("gcs_path", STRING), ("business_line", STRING), ("entity_id", STRING),
        ("fecha_archivo", DATE), ("status", STRING), ("fecha_carga", TIMESTAMP), ("error_mensaje", STRING),
    ),
    required=("gcs_path", "business_line", "entity_id", "fecha_archivo"),
    defaults=(("load_id", DEFAULT_UUID), ("status", fv.LEDGER_PENDING)),
    partition="fecha_archivo",
    cluster=("gcs_path",),
    apart=f"status IS DISTINCT FROM '{fv.LEDGER_DONE}'",
)

ACCOUNTS = TableSpec(
    "pipeline_management/account_catalog",
    _schema(
        ("account_id", STRING), ("account_name", STRING), ("platform", STRING), ("area", STRING),
        ("tipo", STRING), ("currency", STRING), ("timezone", STRING), ("activo", BOOLEAN),
        ("created_at", TIMESTAMP), ("extraction_status", STRING), ("ultima_extraccion", TIMESTAMP),
    ),
    required=("account_id", "platform"),
    defaults=(("activo", True), ("created_at", DEFAULT_NOW)),
    cluster=("account_id",),
)

EXTRACTION_CONTROL = TableSpec(
    "pipeline_management/campaigns_extraction_control",
    _schema(
        ("campaign_id", STRING), ("account_id", STRING), ("platform", STRING),
        ("last_insight_date", DATE), ("extraction_status", STRING), ("ultima_extraccion", TIMESTAMP),
    ),
    required=("campaign_id",),
    cluster=("campaign_id",),
    buckets=("campaign_id",),
)

SUBITEMS = TableSpec("silver_layer/subitems_digital", _schema(("campaign_id", STRING)))

CAMPAIGNS = TableSpec(
    "silver_layer/campaigns",
    _schema(
        ("account_id", STRING), ("campaign_id", STRING), ("campaign_name", STRING), ("status", STRING),
        ("objective", STRING), ("budget_rebalance_flag", BOOLEAN), ("daily_budget", DOUBLE),
        ("lifetime_budget", DOUBLE), ("start_time", TIMESTAMP), ("stop_time", TIMESTAMP),
        ("created_time", TIMESTAMP), ("updated_time", TIMESTAMP), ("platform", STRING), ("loaded_at", TIMESTAMP),
    ),
    required=("account_id", "campaign_id"),
    cluster=("campaign_id",),
    buckets=("campaign_id",),
)

INSIGHTS = TableSpec(
    "silver_layer/campaign_insights",
    _schema(
        ("account_id", STRING), ("campaign_id", STRING), ("date_information", DATE), ("impressions", LONG),
        ("clicks", LONG), ("spend", DOUBLE), ("purchases", LONG), ("value_purchases", DOUBLE),
        ("platform", STRING), ("row_hash", STRING), ("updated_at", TIMESTAMP),
    ),
    required=("account_id", "campaign_id", "date_information", "platform", "row_hash"),
    defaults=(("updated_at", DEFAULT_NOW),),
    partition="date_information",
    cluster=("account_id", "campaign_id"),
    feed=("campaign_id", "date_information"),
)

FACT = TableSpec(
    "gold_layer/fact_campaign_performance",
    _schema(
        ("date_information", DATE, "Day of the metrics"),
        ("campaign_id", STRING, "Foreign key to dim_campaigns"),
        ("account_id", STRING, "Advertising account the row came from"),
        ("impressions", LONG, "Impressions of the day"),
        ("clicks", LONG, "Clicks of the day"),
        ("spend", DOUBLE, "Money spent on the day"),
        ("purchases", DOUBLE, "Purchases attributed to the day"),
        ("value_purchases", DOUBLE, "Money value of those purchases"),
        ("platform", STRING, "Advertising platform"),
        ("row_hash", STRING, "Hash that tells late corrections apart"),
        ("inserted_at", TIMESTAMP, "Time of the last write of the row"),
    ),
    required=("date_information", "campaign_id"),
    defaults=(("inserted_at", DEFAULT_NOW),),
    partition="date_information",
    cluster=("platform", "campaign_id"),
)

DIM_CAMPAIGNS = TableSpec(
    "gold_layer/dim_campaigns",
    _schema(
        ("campaign_id", STRING), ("campaign_name", STRING), ("status", STRING), ("objective", STRING),
        ("start_time", TIMESTAMP), ("stop_time", TIMESTAMP), ("platform", STRING),
    ),
    required=("campaign_id",),
    cluster=("campaign_id",),
)

# Fields asked of the raw campaign and insight files. VARIANT where missing, null,
# text and number are to be told apart; plain text where they are not.
CAMPAIGN_FIELDS = {
    "id": "variant", "name": "string", "status": "string", "objective": "string",
    "budget_rebalance_flag": "variant", "daily_budget": "variant", "lifetime_budget": "variant",
    "start_time": "variant", "stop_time": "variant", "created_time": "variant", "updated_time": "variant",
}
INSIGHT_FIELDS = dict.fromkeys(
    ("campaign_id", "date_stop", "impressions", "clicks", "spend", "actions", "action_values"), "variant"
)
