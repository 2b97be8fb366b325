"""The outbreak record model: schemas, cleaning rules, dimension and fact definitions."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import AsOf
from ..operators.dedup import dedup
from ..operators.quality import drop_any_blank, min_bound, quality_funnel, require
from ..operators.standardize import fill_from_groups, project, rename, repair_like, standardize, with_measure, with_stamp
from ..operators.star import DimSpec, FactSpec, Fallback
from ..sources.layers import with_lineage, with_load_date

# The columns of a raw outbreak file, in file order; all text but the year.
RAW_COLUMNS = (
    "id_outbreak",
    "Year",
    "icd10n",
    "icd103n",
    "icd104n",
    "icd10c",
    "icd103c",
    "icd104c",
    "Disease",
    "Definition",
    "Country",
    "iso2",
    "iso3",
    "unsd_region",
    "unsd_subregion",
    "who_region",
    "DONs",
)
RAW_SCHEMA = T.StructType(
    [T.StructField(c, T.IntegerType() if c == "Year" else T.StringType()) for c in RAW_COLUMNS]
)

# Columns a raw record must have, and the raw -> bronze names of the columns that are kept.
REQUIRED = ("id_outbreak", "Year", "Disease", "Country", "iso3")
BRONZE_NAMES = {
    "id_outbreak": "outbreak_id",
    "Year": "year",
    "Disease": "disease_name",
    "Definition": "definition",
    "icd10c": "icd10_general",
    "icd104c": "icd104_specific",
    "Country": "country",
    "iso3": "iso3",
    "who_region": "who_region",
    "unsd_region": "unsd_region",
    "unsd_subregion": "unsd_subregion",
    "DONs": "don_id",
}

# Columns in upper case, columns only trimmed.
UPPER = ("disease_name", "country", "iso3", "icd10_general", "who_region", "unsd_region", "unsd_subregion")
TRIM = ("definition", "don_id", "icd104_specific", "outbreak_id")

# Country spellings broken by encoding, as LIKE patterns, and what they stand for.
COUNTRY_REPAIRS = (
    ("C%TE D'IVOIRE", "COTE D'IVOIRE"),
    ("R%UNION", "REUNION"),
    ("CURA%AO", "CURACAO"),
    ("SAINT BARTH%LEMY", "SAINT BARTHELEMY"),
)

# Territories whose region is missing in the source, by region.
REGION_GROUPS = {
    "Americas": (
        "SAINT BARTHELEMY", "ANGUILLA", "CURACAO", "BERMUDA", "SAINT PIERRE AND MIQUELON",
        "BONAIRE SINT EUSTATIUS AND SABA", "MARTINIQUE", "SAINT MARTIN (FRENCH PART)", "MONTSERRAT",
        "SINT MAARTEN (DUTCH PART)", "VIRGIN ISLANDS (BRITISH)", "FALKLAND ISLANDS (MALVINAS)", "PUERTO RICO",
        "FRENCH GUIANA", "VIRGIN ISLANDS (U.S.)", "TURKS AND CAICOS ISLANDS", "ARUBA", "GUADELOUPE",
        "CAYMAN ISLANDS",
    ),
    "Europe": (
        "KOSOVO", "GREENLAND", "HOLY SEE", "JERSEY", "GIBRALTAR", "FAROE ISLANDS", "GUERNSEY", "ISLE OF MAN",
        "LIECHTENSTEIN",
    ),
    "Asia": ("TAIWAN PROVINCE OF CHINA", "MACAO", "PALESTINE STATE OF", "HONG KONG"),
    "Africa": ("SAINT HELENA ASCENSION AND TRISTAN DA CUNHA", "REUNION", "MAYOTTE"),
    "Oceania": (
        "TOKELAU", "AMERICAN SAMOA", "FRENCH POLYNESIA", "NEW CALEDONIA", "GUAM", "NORTHERN MARIANA ISLANDS",
        "PITCAIRN", "WALLIS AND FUTUNA",
    ),
}

# The first year of the record.
FIRST_YEAR = 1996

LOCATION_DIM = DimSpec(
    natural_key="iso3",
    key="location_key",
    attributes=("country", "region_code", "unsd_region", "unsd_subregion"),
    fallbacks=(
        Fallback("unsd_region", ("region_code",), "UNKNOWN", upper=True),
        Fallback("unsd_subregion", (), "Unspecified"),
    ),
)
DISEASE_DIM = DimSpec(
    natural_key="disease_name",
    key="disease_key",
    attributes=("definition", "icd10_general", "icd104_specific"),
    normalize=True,
)
FACT = FactSpec(
    key="outbreak_id",
    columns={"year": "report_year", "don_id": "don_id"},
    id_columns=("location_key", "disease_key", "don_id", "report_year"),
    measure="outbreak_count",
)


@dataclass(frozen=True)
class CleaningRules:
    """What ``clean`` does; every rule skips columns that are absent."""

    key: str = "outbreak_id"
    upper: tuple[str, ...] = UPPER
    trim: tuple[str, ...] = TRIM
    repairs: tuple[tuple[str, str], ...] = COUNTRY_REPAIRS
    repair_col: str = "country"
    groups: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: REGION_GROUPS)
    fill_target: str = "who_region"
    fill_key: str = "country"
    bound: tuple[str, int] = ("year", FIRST_YEAR)
    renames: Mapping[str, str] = field(default_factory=lambda: {"who_region": "region_code"})
    # True: drop first and fill what is left (then nothing is left to fill); False: fill, then drop
    legacy_order: bool = False

    def __post_init__(self):
        # in the legacy order a repair comes after the strict drop, and the final check removes the blanks it makes
        if not self.legacy_order and any(not value.strip() for _, value in self.repairs):
            raise ValueError("a repair must not produce a blank")

    def winner(self) -> list[Column]:
        """Order that decides between rows of one key: the latest year first."""
        return [-F.col(self.bound[0])]

    def repaired(self, df: DataFrame) -> DataFrame:
        df = standardize(df, self.upper, self.trim)
        df = repair_like(df, self.repair_col, self.repairs)
        groups = self.groups
        if not self.legacy_order and self.fill_target in self.upper:
            groups = {label.upper(): keys for label, keys in self.groups.items()}
        return fill_from_groups(df, self.fill_target, self.fill_key, groups)


CLEANING = CleaningRules()


def ingest(raw: DataFrame, as_of: AsOf = None, lineage: bool = True) -> DataFrame:
    """Raw records to bronze: stamp origin and date, require the critical columns, trim and rename.

    ``lineage`` needs ``raw`` to be a file scan; otherwise the frame must bring ``source_file`` itself.
    """
    df = with_load_date(with_lineage(raw) if lineage else raw, as_of)
    df = require(df, [c for c in REQUIRED if c in df.columns])
    return project(df, {**BRONZE_NAMES, "source_file": "source_file", "ingestion_date": "ingestion_date"})


def clean(bronze: DataFrame, rules: CleaningRules = CLEANING, as_of: AsOf = None) -> DataFrame:
    """Bronze to silver: strict quality, one row per key, lower bound, standard values, added columns."""
    if rules.legacy_order:
        df = drop_any_blank(bronze)
    else:
        # trimming and case neither make nor remove blanks: all columns but the filled one are tested as stored,
        # so that their null tests reach the file scan
        df = drop_any_blank(bronze, [c for c in bronze.columns if c != rules.fill_target])
        df = drop_any_blank(rules.repaired(df), [rules.fill_target])
    if rules.key in df.columns:
        order = rules.winner() if rules.bound[0] in df.columns else []
        df = dedup(df, [rules.key], order)
    df = min_bound(df, *rules.bound)
    if rules.legacy_order:
        df = rules.repaired(df)
    df = rename(df, {k: v for k, v in rules.renames.items() if k in df.columns})
    df = with_measure(with_stamp(df, "cleaning_timestamp", as_of), "outbreak_count")
    return df


def cleaning_funnel(bronze: DataFrame, rules: CleaningRules = CLEANING) -> DataFrame:
    """How many bronze rows ``clean`` drops at each step, in one pass."""
    df = bronze if rules.legacy_order else rules.repaired(bronze)
    return quality_funnel(df, [rules.key], rules.bound)
