"""Settings of a run from a configuration file (sections of ``key = value`` lines)."""

from __future__ import annotations

import configparser
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from clipforge.functions import constants as C
from clipforge.operators.blocklists import comma_list


@dataclass
class Settings:
    """What the operators take as arguments; the defaults hold for a missing file."""
    languages: list = field(default_factory=lambda: list(C.ALLOWED_LANGUAGES))
    faculties: list = field(default_factory=list)
    blacklist: list = field(default_factory=lambda: list(C.BLACKLIST_NAMES))
    patterns: list = field(default_factory=lambda: list(C.UNWANTED_TERM_PATTERNS))
    source_urls: dict = field(default_factory=lambda: dict(C.SOURCE_URL_MAP))
    workflow: dict = field(default_factory=lambda: dict(C.WORKFLOW_STATUS))
    name_nl: str = C.INSTITUTION_NAME_DUTCH
    name_en: str = C.INSTITUTION_NAME_ENGLISH
    use_model: bool = True


def parse_settings(text: str) -> Settings:
    """Settings from the text of a file. A list or section that the file lacks is empty;
    faculty codes are upper-cased, source names lower-cased."""
    c = configparser.ConfigParser()
    c.read_string(text)
    section = lambda name: dict(c[name]) if c.has_section(name) else {}
    return Settings(
        languages=comma_list(c.get("DEFAULTS", "ALLOWED_LANGUAGES", fallback="")),
        faculties=comma_list(c.get("DEFAULTS", "VALID_FACULTIES", fallback="")),
        blacklist=comma_list(c.get("FILTERS", "BLACKLIST_NAMES", fallback="")),
        patterns=comma_list(c.get("FILTERS", "UNWANTED_TERMS", fallback="")),
        source_urls=section("SOURCE_MAP"),
        workflow={k.upper(): v for k, v in section("WORKFLOW STATUS").items()},
        name_nl=c.get("NAME", "DUTCH", fallback=""), name_en=c.get("NAME", "ENGLISH", fallback=""),
        use_model=c.getboolean("AI", "AI", fallback=True))


def read_settings(spark: SparkSession, path: str) -> Settings:
    """Settings from a file in any store that Spark reads; the defaults if there is none."""
    try:
        row = spark.read.text(path, wholetext=True).first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return Settings()
    return parse_settings(row["value"] if row else "")
