"""The incident data model: tables, column roles and wording."""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Column names and words that results must carry.
# ---------------------------------------------------------------------------
KEY = "incident_id"
TARGET = "total_loss_usd"
ROW_KEY = "row_key"
UNKNOWN = "Desconhecido"

SOURCE_TABLES = ("financial_impact", "incidents_master", "market_impact")

AUDIT_COLUMNS = ("meta_arquivo_origem", "meta_qtd_linhas", "meta_hash_ingestao", "meta_data_carga")

LEAKING_COLUMNS = (
    "downtime_hours",
    "data_compromised_records",
    "disclosure_date",
    "company_name",
    "stock_ticker",
    "notes",
    "created_at",
    "updated_at",
    "industry_secondary",
    "attack_vector_secondary",
    "review_flag",
)

FILLED_CATEGORIES = (
    "attack_chain",
    "attributed_group",
    "attribution_confidence",
    "data_type",
    "data_source_secondary",
    "attack_vector_primary",
    "data_source_primary",
)

TYPED_COLUMNS = (
    "total_loss_usd",
    "company_revenue_usd",
    "employee_count",
    "quality_score",
    "confidence_tier",
)

FLAG_COLUMNS = ("is_public_company", "incident_date_estimated")

MODEL_COLUMNS = (
    "company_revenue_usd",
    "employee_count",
    "is_public_company",
    "industry_primary",
    "attack_vector_primary",
    "data_type",
    "confidence_tier",
    "quality_score",
    "total_loss_usd",
)

CORRELATED = ("total_loss_usd", "company_revenue_usd", "employee_count", "quality_score")

# Columns of the group reports.
GROUP_ROWS, GROUP_MEAN, GROUP_MOST, SECOND_MEAN = "num_incidentes", "perda_media", "perda_maxima", "receita_media"
ALL_ROWS, LEADERS = "total_incidentes", "top1_por_setor"

HIGH, LOW = "Alto", "Baixo"
YES, NO = "SIM", "NAO"
EQUAL = "="
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class RefineSpec:
    """What the refined layer joins, removes, fills and types."""

    key: str = KEY
    target: str = TARGET
    row_key: str = ROW_KEY
    removed: tuple[str, ...] = LEAKING_COLUMNS + AUDIT_COLUMNS + (KEY,)
    filled: tuple[str, ...] = FILLED_CATEGORIES
    fill_value: str = UNKNOWN
    typed: tuple[str, ...] = TYPED_COLUMNS
    flags: tuple[str, ...] = FLAG_COLUMNS


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns play which part in the feature layer."""

    row_key: str = ROW_KEY
    kept: tuple[str, ...] = MODEL_COLUMNS
    ordinal: tuple[str, ...] = ("confidence_tier",)
    nominal: tuple[str, ...] = ("industry_primary", "attack_vector_primary", "data_type")
    imputed: tuple[str, ...] = ("company_revenue_usd", "employee_count", "quality_score")
    scaled: tuple[str, ...] = ("company_revenue_usd", "employee_count")
    capped: str = TARGET
    z_clipped: str = "company_revenue_usd"
    train_fraction: float = 0.8
    fence_factor: float = 1.5
    z_limit: float = 3.0
    quantile_rule: str = "linear"
    ddof: int = 0
    widest_vocabulary: int = 512  # categories a nominal column may have; fit refuses more
    indexed: tuple[str, ...] = ()  # text columns of any width that get one code column
