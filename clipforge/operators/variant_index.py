"""A stored index of the directory's spellings for the fuzzy match.

``fuzzy_pairs`` expands both sides on every run. The index holds the directory's side as
tables bucketed by the join key, so a run expands and shuffles its mentions alone:

* ``variants`` and ``grams`` -- the deletion variants and q-grams of every distinct spelling;
* ``persons`` -- (spelling_key, uuid, pos), bucketed by the spelling;
* ``gone`` -- tombstones: the uuids of persons that a generation replaced or removed.

A change writes a generation of its own and rewrites nothing: spellings the index knows get
no new entries, and a person's rows count only if no later generation has a tombstone for
them. Entries of spellings that no person has any more meet no person. ``compacted`` writes
one generation of what is left; ``changed`` does so by itself from ``MAX_GENERATIONS`` on.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipforge.functions import constants as C
from clipforge.functions.text import strip_ws
from clipforge.operators.entities import directory_spellings
from clipforge.operators.fuzzy import best_match, gram_entries, pairs_with, variant_entries
from clipforge.session import scratch_path

MAX_GENERATIONS = 8


@dataclass
class VariantIndex:
    """Names of the tables of an index, one generation after another."""

    spark: SparkSession
    buckets: int
    threshold: int = C.MATCH_THRESHOLD
    variants: list[str] = field(default_factory=list)
    grams: list[str] = field(default_factory=list)
    persons: list[str] = field(default_factory=list)
    gone: list[str] = field(default_factory=list)


def _save(index: VariantIndex, df: DataFrame, kind: str, key: str) -> str:
    name = f"{kind}_{uuid.uuid4().hex}"
    df.write.bucketBy(index.buckets, key).sortBy(key).option("path", scratch_path(index.spark, f"variant_index/{name}")).saveAsTable(name)
    return name


def _generation(index: VariantIndex, spellings: DataFrame, known: list[str]) -> dict[str, str]:
    """Write the entries of the spellings (spelling_key, uuid, pos) that no ``known`` table has."""
    persons = _save(index, spellings.select("spelling_key", "uuid", "pos").distinct(), "persons", "spelling_key")
    new = index.spark.table(persons).select("spelling_key").distinct()
    for name in known:
        new = new.join(index.spark.table(name), "spelling_key", "left_anti")
    new = new.select(F.col("spelling_key").alias("_rid"), F.col("spelling_key").alias("_rs"))
    grams = gram_entries(new, "_rid", "_rs", index.threshold)
    return {"persons": persons, "variants": _save(index, variant_entries(new, "_rid", "_rs", index.threshold), "variants", "variant"),
            "grams": _save(index, grams, "grams", "g")}


def _spellings(directory: DataFrame) -> DataFrame:
    return directory_spellings(directory).select(F.lower("spelling").alias("spelling_key"), "uuid", "pos")


def build_index(directory: DataFrame, buckets: int | None = None, threshold: int = C.MATCH_THRESHOLD) -> VariantIndex:
    """An index of the whole directory. ``buckets`` should put one bucket of the largest table
    (some hundred entries a spelling) at what a task holds; unset, the shuffle partitions."""
    spark = directory.sparkSession
    index = VariantIndex(spark, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), threshold)
    return _with(index, _generation(index, _spellings(directory), []), None)


def _with(index: VariantIndex, made: dict[str, str], gone: str | None) -> VariantIndex:
    return VariantIndex(index.spark, index.buckets, index.threshold, [*index.variants, made["variants"]], [*index.grams, made["grams"]],
                        [*index.persons, made["persons"]], [*index.gone, gone or ""])


def changed(index: VariantIndex, persons: DataFrame, removed: DataFrame | None = None) -> VariantIndex:
    """The index with ``persons`` (directory rows) added, in place of any rows with their uuid,
    and the uuids in ``removed`` taken out. Removing an unknown uuid changes nothing; a uuid in
    both is replaced."""
    uuids = persons.select("uuid") if removed is None else persons.select("uuid").unionByName(removed.select("uuid"))
    gone = _save(index, uuids.where("uuid is not null").distinct(), "gone", "uuid")
    out = _with(index, _generation(index, _spellings(persons), index.persons), gone)
    return compacted(out) if len(out.persons) >= MAX_GENERATIONS else out


def living(index: VariantIndex, keys: DataFrame | None = None) -> DataFrame:
    """(spelling_key, uuid, pos) of the persons in the index; with ``keys`` (spelling_key, ...),
    those rows joined with them."""
    parts = []
    for g, name in enumerate(index.persons):
        rows = index.spark.table(name)
        rows = rows if keys is None else keys.join(rows, "spelling_key")
        for later in index.gone[g + 1:]:
            rows = rows.join(index.spark.table(later), "uuid", "left_anti")
        parts.append(rows)
    return reduce(DataFrame.unionByName, parts)


def compacted(index: VariantIndex) -> VariantIndex:
    """One generation with the living persons and the entries of their spellings."""
    one = VariantIndex(index.spark, index.buckets, index.threshold)
    return _with(one, _generation(one, living(index), []), None)


def match_indexed(mentions: DataFrame, index: VariantIndex, mention_col: str = "mention") -> DataFrame:
    """As ``entities.match_mentions``, (mention_key, uuid, pos, d, L), against an index."""
    keys = mentions.select(F.lower(strip_ws(mention_col)).alias("mention_key")).distinct()
    left = keys.where(F.length("mention_key") > 0).select(F.col("mention_key").alias("_lid"), F.col("mention_key").alias("_ls"))
    pairs = reduce(DataFrame.unionByName, [
        pairs_with(left, index.spark.table(v), index.spark.table(g), index.threshold)
        for v, g in zip(index.variants, index.grams, strict=True)])
    pairs = pairs.select(F.col("_lid").alias("mention_key"), F.col("_rid").alias("spelling_key"), "d", "L")
    return best_match(living(index, pairs), "mention_key", "uuid", rank_cols=["pos"])
