"""JSON dictionaries: precincts by municipality and phrases by category."""

from __future__ import annotations

import json
import logging
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bitacora.fixed_values import PHRASES, PRECINCTS
from bitacora.functions.text import strip
from bitacora.sources.reports import literal_path

log = logging.getLogger(__name__)

# A dictionary file up to this size is shipped to every executor.
BROADCAST_BYTES = 8 * 1024 * 1024


@dataclass
class Precincts:
    """Lookup table (municipio upper-case and unique, comisaria)."""

    frame: DataFrame
    is_small: bool


def _read_whole(spark: SparkSession, path: str) -> DataFrame | None:
    """One row per file: text, path and size; None when the path does not exist."""
    try:
        return spark.read.text(literal_path(spark, path), wholetext=True).select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_size").alias("bytes"),
        )
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def default_precincts(spark: SparkSession) -> Precincts:
    pairs = {name.upper(): pid for pid, names in PRECINCTS.items() for name in names}
    frame = spark.createDataFrame(list(pairs.items()), "municipio string, comisaria string")
    return Precincts(frame, True)


def load_precincts(spark: SparkSession, path: str) -> Precincts | None:
    """Precincts from a JSON object id -> [municipality, ...].

    Where a municipality occurs more than once the last id wins, of the last file.  A missing
    file gives None; text that is not such an object is an error.
    """
    raw = _read_whole(spark, path)
    if raw is None:
        log.warning("no precinct dictionary at %s: precincts stay empty", path)
        return None
    size = raw.agg(F.sum("bytes")).first()[0] or 0
    parsed = F.from_json("value", "map<string,array<string>>", {"mode": "FAILFAST"})
    frame = (
        raw.select("file", F.posexplode(F.map_entries(parsed)).alias("_id_at", "_entry"))
        .select(
            "file",
            "_id_at",
            F.col("_entry.key").alias("comisaria"),
            F.posexplode("_entry.value").alias("_name_at", "_name"),
        )
        .groupBy(F.upper("_name").alias("municipio"))
        .agg(F.max_by("comisaria", F.struct("file", "_id_at", "_name_at")).alias("comisaria"))
    )
    return Precincts(frame, size <= BROADCAST_BYTES)


def load_phrases(spark: SparkSession, path: str | None = None) -> dict[str, list[str]] | None:
    """Phrases from a JSON object category -> [phrase, ...].

    None, meaning that no phrase is replaced, for a missing or broken file.
    Several files count as one, in the order of their paths.  The phrases become
    part of the plan, so all of them pass through the driver.
    """
    if path is None:
        return PHRASES
    raw = _read_whole(spark, path)
    if raw is None:
        log.warning("no phrase dictionary at %s: phrases are kept", path)
        return None
    found: dict[str, list[str]] = {}
    try:
        for row in raw.orderBy("file").collect():
            for category, phrases in json.loads(row["value"]).items():
                found.setdefault(str(category), []).extend(str(p) for p in phrases)
        return found or None
    except (ValueError, AttributeError, TypeError) as error:
        log.warning("cannot read phrase dictionary %s: %s", path, error)
        return None


def load_phrase_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The same phrases as a table (phrase, new) that never passes through the driver.

    Phrases are in lower case, the last category of one counts, and a blank category
    replaces by a space.  None for a missing or broken file.
    """
    raw = _read_whole(spark, path)
    if raw is None:
        log.warning("no phrase dictionary at %s: phrases are kept", path)
        return None
    parsed = raw.select("file", F.from_json("value", "map<string,array<string>>").alias("found"))
    if not parsed.where("found IS NULL").isEmpty():
        log.warning("cannot read phrase dictionary %s", path)
        return None
    return (
        parsed.select("file", F.posexplode(F.map_entries("found")).alias("_category_at", "_entry"))
        .select("file", "_category_at", "_entry.key", F.posexplode("_entry.value").alias("_at", "_phrase"))
        .where("_phrase <> ''")
        .groupBy(F.lower("_phrase").alias("phrase"))
        .agg(F.max_by("key", F.struct("file", "_category_at", "_at")).alias("category"))
        .select("phrase", F.when(strip(F.col("category")) == "", " ").otherwise(F.col("category")).alias("new"))
    )
