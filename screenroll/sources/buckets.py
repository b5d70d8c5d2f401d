"""Staging tables bucketed and sorted by entity, so that the star join reads them without any exchange.

Every table is divided by the hash of its entity into the same number of buckets, one sorted file each.
Grouping, ranking and joining by entity then happen bucket by bucket, in place. Entities with too many
rows for one task in any table (see ``plans.skew``) would make their bucket as large as they are, and so would
the rows without an entity: these stand in plain files beside the buckets, for all tables alike, and go through
the spread-out plan. As every operator works entity by entity, the list is that of the one half and of the other.

The tables are external ones: files below a folder, known to the catalog by name. A session that does
not know them yet declares them again from the pointer of the folder.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.consolidate import many_inputs
from ..plans.pointer import current, point_to
from ..plans.skew import DEFAULT_POLICY, NO_SKEW, Heavy, Keys, SkewPolicy, heavy_keys
from ..schemas import KEY

#: Tables of the star join that can repeat within an entity.
STAR = {"Entity", "EntityAddress", "EntityAlias", "EntityCountryAssociation", "EntityEnforcement", "EntitySanction"}
#: Tables that are joined by something else stay whole.
WHOLE = ("Country", "EntityAdverseMediaSubCategory", "EntityEnforcementSubCategory")


def bucket_feed(
    tables: dict[str, DataFrame], root: str, buckets: int, policy: SkewPolicy = DEFAULT_POLICY
) -> tuple[dict[str, DataFrame], dict[str, DataFrame] | None]:
    """Store staging tables by entity under ``root``; returns the tables as ``bucketed_feed`` does.

    One task joins a bucket of all tables, so there are at least ``buckets``, and as many more as it takes
    to have about ``rows_per_task`` rows of them in each. A load that dies leaves the tables stored before.
    """
    spark = next(iter(tables.values())).sparkSession
    keyed = {name: df for name, df in tables.items() if KEY in df.columns and name not in WHOLE}
    # Rows of the inputs that the star join multiplies, and of every table by itself.
    joined = {}
    if STAR <= set(tables):
        joined = {f"joined {n}": df for n, df in (many_inputs(tables) | {"alias": tables["EntityAlias"]}).items()}
    found = heavy_keys(keyed | joined, policy, joined=list(joined or keyed))
    heavy, rows = _all_heavy(found), sum(found.facts[f"light{found.frames.index(name)}"] for name in keyed)
    buckets = max(buckets, -(-rows // policy.rows_per_task))
    load, entries = uuid.uuid4().hex, {}
    for name, df in tables.items():
        path = f"load={load}/{name}"
        entry = {"path": path, "schema": df.schema.json()}
        if name in keyed:
            known, apart = df.where(F.col(KEY).isNotNull()), df.where(F.col(KEY).isNull())
            if heavy:
                known, apart = heavy.others(known, KEY), apart.unionByName(heavy.of(df, KEY))
            _write_buckets(known, f"{root}/{path}/light", f"by_entity_{load}_{name}", buckets)
            seen = Observation(f"apart {name}")
            apart.observe(seen, F.count("*").alias("n")).write.parquet(f"{root}/{path}/heavy")
            entry |= {"table": f"by_entity_{load}_{name}", "ddl": _ddl(df), "heavy": seen.get["n"] or 0}
        else:
            df.write.parquet(f"{root}/{path}/whole")
        entries[name] = entry
    point_to(spark, root, lambda _: {"tables": entries, "buckets": buckets})
    return bucketed_feed(spark, root)


def _all_heavy(found: Heavy) -> Keys | None:
    """Entities that are heavy in a table or by their product, as one list for all tables."""
    count = found.facts["products"] + sum(found.facts[f"h{i}"] for i in range(len(found.frames)))
    if not count:
        return None
    return Keys(found.rows.select(F.col("k").alias("_key"), F.lit(0).cast("long").alias("_n")), count, 0)


def _write_buckets(df: DataFrame, path: str, name: str, buckets: int) -> None:
    # Dealt out as the buckets are, so that each bucket is written by one task, as one file.
    df.repartition(buckets, KEY).write.bucketBy(buckets, KEY).sortBy(KEY).option("path", path).saveAsTable(name)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def bucketed_feed(spark: SparkSession, root: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame] | None]:
    """The current tables under ``root``: those in buckets, and the rows that stand apart (None if there are none).

    Tables without an entity are in both.
    """
    found = current(spark, root)
    if found is None:
        raise ValueError(f"no complete load under {root}")
    light, heavy = {}, {}
    for name, entry in found["tables"].items():
        path = f"{root}/{entry['path']}"
        if "table" not in entry:
            light[name] = heavy[name] = spark.read.parquet(f"{path}/whole")
            continue
        if not spark.catalog.tableExists(entry["table"]):
            spark.sql(
                f"create table {entry['table']} ({entry['ddl']}) using parquet clustered by ({KEY}) sorted by ({KEY}) "
                f"into {found['buckets']} buckets location '{path}/light'")
        light[name] = spark.table(entry["table"])
        heavy[name] = spark.read.schema(light[name].schema).parquet(f"{path}/heavy")
    some = any(entry.get("heavy") for entry in found["tables"].values())
    return light, heavy if some else None


def over_buckets(operator, halves: tuple[dict[str, DataFrame], dict[str, DataFrame] | None], *args, **options) -> DataFrame:
    """An operator that works entity by entity over both halves of a bucketed feed.

    The half in buckets is planned without a look for heavy entities, as it has none.
    """
    light, heavy = halves
    policy = options.pop("policy", DEFAULT_POLICY)
    parts = [operator(light, *args, policy=NO_SKEW, **options)]
    if heavy is not None:
        parts.append(operator(heavy, *args, policy=policy, **options))
    return reduce(DataFrame.unionByName, parts)
