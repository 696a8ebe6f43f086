"""Silver: renamed, cleaned, typed, deduplicated rows under a contract."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.functions import cleaning, geo
from lamina.operators.latest import keep_last
from lamina.operators.quality import RowCounts
from lamina.operators.shaping import (
    conform,
    derive,
    keep_known,
    rename_known,
    rename_strict,
    text_columns,
    union_drifted,
)
from lamina.plans import schemas, sources
from lamina.sources.raw import SEQUENCE_COLUMNS

YEAR = "_source_year"
ROW_ORDER = (YEAR, *SEQUENCE_COLUMNS)
STAGED = frozenset((*schemas.STAGED_LINEAGE, *SEQUENCE_COLUMNS, YEAR))

KEY_WIDTH = 7
NO_KEY = "0" * KEY_WIDTH


@dataclass
class SilverTable:
    """A Silver frame with the years that went into it."""

    df: DataFrame
    processed_years: list[int] = field(default_factory=list)
    skipped_years: list[int] = field(default_factory=list)


def _tap(counts: RowCounts | None, df: DataFrame, stage: str) -> DataFrame:
    """Count rows here when asked; a tap keeps Catalyst from pruning across it."""
    return df if counts is None else counts.tap(df, stage)


def _stamp(df: DataFrame, extraction_date: date, cleansed_at: datetime | None) -> DataFrame:
    moment = cleansed_at or datetime.now(tz=timezone.utc)
    stamped = df.withColumn("_cleansed_at", F.lit(moment))
    return stamped.withColumn("_extraction_date", F.lit(extraction_date))


def _order_columns(df: DataFrame) -> dict[str, str]:
    """Constant positions for frames that were staged without them."""
    return {c: "0L" for c in ("_block_start", "_row_seq") if c not in df.columns}


def _by_year(frames: Mapping[int, DataFrame], names: Mapping[str, str]) -> list[DataFrame]:
    allowed = set(names.values()) | STAGED
    return [
        derive(
            keep_known(rename_known(frame, names), allowed),
            {YEAR: str(year), **_order_columns(frame)},
        )
        for year, frame in sorted(frames.items())
    ]


def _key(name: str) -> str:
    return cleaning.zero_fill(cleaning.strip_blank(name), KEY_WIDTH)


def establishments(
    df: DataFrame, extraction_date: date, cleansed_at: datetime | None = None
) -> SilverTable:
    """Master data. No deduplication: a repeated key breaks the contract."""
    named = rename_strict(df, sources.ESTABLISHMENT_NAMES)
    flags = schemas.ESTABLISHMENT_FLAGS
    coordinates = {"nu_latitude": geo.LATITUDE_RANGE, "nu_longitude": geo.LONGITUDE_RANGE}
    cleaned = derive(
        named,
        {
            **{c: cleaning.clean_text(c) for c in text_columns(named, {*flags, *coordinates})},
            **{c: cleaning.flag_from_number(c) for c in flags},
            **{c: geo.coordinate(c, *limits) for c, limits in coordinates.items()},
        },
    )
    stamped = _stamp(cleaned, extraction_date, cleansed_at)
    return SilverTable(conform(stamped, schemas.ESTABLISHMENTS.schema))


def beds(
    frames: Mapping[int, DataFrame],
    extraction_date: date,
    *,
    skipped_years: list[int] | None = None,
    normalize_keys: bool = False,
    clean_names: bool = False,
    cleansed_at: datetime | None = None,
    counts: RowCounts | None = None,
) -> SilverTable:
    """Monthly bed declarations of all years, in either header spelling.

    Establishment keys and descriptive strings are taken as they come; the two
    options pad the keys to seven digits and clean the strings. Pass ``counts``
    to have rows counted around the filter and the deduplication.
    """
    measures = schemas.BED_MEASURES
    union = union_drifted(_by_year(frames, sources.BED_NAMES))
    declared = {m: cleaning.strict_count(m) for m in measures if m in union.columns}
    typed = derive(union, {**declared, "ano_referencia": cleaning.leading_year("comp")})
    if normalize_keys:
        typed = derive(typed, {"cnes": _key("cnes")})
    if clean_names:
        named = text_columns(typed, {"comp", "cnes"})
        typed = derive(typed, {c: cleaning.clean_text(c) for c in named})
    typed = _tap(counts, typed, "read")
    dated = _tap(counts, typed.where(cleaning.is_period("comp")), "valid_period")
    unique = _tap(counts, keep_last(dated, ["cnes", "comp"], ROW_ORDER), "deduplicated")
    # A measure that no year has is a constant: added after the shuffle.
    unique = derive(unique, {m: "0L" for m in measures if m not in declared})
    stamped = _stamp(unique, extraction_date, cleansed_at)
    return SilverTable(
        conform(stamped, schemas.BEDS.schema),
        processed_years=sorted(frames),
        skipped_years=sorted(skipped_years or []),
    )


def occupancy(
    frames: Mapping[int, DataFrame],
    extraction_date: date,
    *,
    cleansed_at: datetime | None = None,
    counts: RowCounts | None = None,
) -> SilverTable:
    """Occupancy notifications of all years."""
    junk = sources.OCCUPANCY_JUNK
    tidy = {year: frame.drop(*junk) for year, frame in frames.items()}
    union = union_drifted(_by_year(tidy, sources.OCCUPANCY_NAMES))
    moments = ("data_notificacao", "registro_created_at", "registro_updated_at")
    words = ("excluido", "validado")
    texts = ("estado_notificacao", "municipio_notificacao", "estado", "municipio", "origem")
    # The identity is tested on the raw cells where that is the same test, so that
    # the key is not computed a second time inside a pushed-down filter.
    union = _tap(counts, union, "read").where("id_registro IS NOT NULL AND cnes IS NOT NULL")
    typed = derive(
        union,
        {
            **{c: cleaning.utc_timestamp(c) for c in moments},
            **{c: cleaning.lenient_count(c) for c in schemas.OCCUPANCY_MEASURES},
            **{c: cleaning.flag_from_word(c) for c in words},
            **{c: cleaning.clean_text(c) for c in texts},
            "cnes": _key("cnes"),
        },
    )
    identified = typed.where("data_notificacao IS NOT NULL")
    dated = identified.withColumn("ano_referencia", F.year("data_notificacao"))
    dated = _tap(counts, dated, "identified")
    unique = _tap(counts, keep_last(dated, ["id_registro"], ROW_ORDER), "deduplicated")
    stamped = _stamp(unique, extraction_date, cleansed_at)
    return SilverTable(conform(stamped, schemas.OCCUPANCY.schema), processed_years=sorted(frames))


def care_units(
    df: DataFrame,
    extraction_date: date,
    *,
    cleansed_at: datetime | None = None,
    counts: RowCounts | None = None,
) -> SilverTable:
    """Primary-care units; coordinates are written with a decimal comma."""
    named = derive(rename_strict(df, sources.CARE_UNIT_NAMES), _order_columns(df))
    texts = ("co_uf", "co_ibge", "no_unidade", "no_logradouro", "no_bairro")
    coordinates = {"nu_latitude": geo.LATITUDE_RANGE, "nu_longitude": geo.LONGITUDE_RANGE}
    cleaned = derive(
        named,
        {
            **{c: cleaning.clean_text(c) for c in texts},
            **{c: geo.coordinate_decimal_comma(c, *limits) for c, limits in coordinates.items()},
            "cnes": _key("cnes"),
        },
    )
    cleaned = _tap(counts, cleaned, "read")
    keyed = _tap(counts, cleaned.where(F.col("cnes") != NO_KEY), "keyed")
    unique = _tap(counts, keep_last(keyed, ["cnes"], SEQUENCE_COLUMNS), "deduplicated")
    stamped = _stamp(unique, extraction_date, cleansed_at)
    return SilverTable(conform(stamped, schemas.CARE_UNITS.schema))
