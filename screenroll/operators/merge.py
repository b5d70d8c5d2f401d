"""Merging the texts of an entity into one value."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fit
from ..plans.skew import DEFAULT_POLICY, Heavy, Keys, SkewPolicy, heavy_keys
from ..schemas import KEY, NATIONAL_ID_PREFIX

SEPARATOR = "; "


def merge_text(
    df: DataFrame,
    key: str,
    widths: dict[str, int | None],
    sep: str = SEPARATOR,
    null_if_single: bool = False,
    heavy: Keys | None = None,
    salts: int = 256,
) -> DataFrame:
    """One row per key: the distinct texts of each column, ascending, joined by ``sep``.

    ``widths`` maps each column to the width its result is cut to, or None.
    Blank texts are left out; a key with blank texts only gets ``''``, or NULL
    with ``null_if_single`` if it has one row and that is NULL. Rows without a
    key are dropped.

    Equal texts collapse before the shuffle. Of a cut column only the texts
    that begin within the width can show, so the others are dropped before
    they are collected: what is collected per key is bounded by the width;
    columns without a width are collected whole. The ``heavy`` keys are pre-cut in ``salts`` groups first.
    """
    columns = list(widths)
    ids = {c: i for i, c in enumerate(columns)}
    rows = df.where(F.col(key).isNotNull())
    if len(columns) > 1:
        pieces = [
            F.struct(F.lit(i).alias("_col"), F.col(c).cast("string").alias("_raw"))
            for c, i in ids.items()
        ]
        rows = rows.select(key, F.inline(F.array(*pieces)))
    else:
        rows = rows.select(key, F.col(columns[0]).cast("string").alias("_raw"))
    texts = rows.withColumn("_text", F.nullif("_raw", F.lit("")))
    group = [key, "_col"] if len(columns) > 1 else [key]
    counts = (
        [F.count("*").alias("_rows"), F.count("_raw").alias("_filled")] if null_if_single else []
    )
    if counts:
        texts = texts.groupBy(*group, "_text").agg(*counts)
    else:
        texts = texts.select(*group, "_text").distinct()

    by_id = {ids[c]: w for c, w in widths.items() if w}
    if by_id:
        whole = None
        if len(by_id) < len(columns):
            cut = F.col("_col").isin(list(by_id))
            whole, texts = texts.where(~cut), texts.where(cut)
        if heavy:
            light = heavy.others(texts, key)
            dense = heavy.of(texts, key).withColumn("_salt", F.pmod(F.xxhash64("_text"), F.lit(salts)))
            dense = _within_width(dense, [*group, "_salt"], by_id, sep).drop("_salt")
            texts = light.unionByName(dense)
        texts = _within_width(texts, group, by_id, sep)
        if whole is not None:
            texts = texts.unionByName(whole)

    def merged(column: str):
        text = F.col("_text")
        if len(columns) > 1:
            text = F.when(F.col("_col") == ids[column], text)
        joined = F.array_join(F.sort_array(F.collect_list(text)), sep)
        if widths[column]:
            joined = fit(joined, widths[column])
        if null_if_single:
            mine = F.col("_col") == ids[column] if len(columns) > 1 else F.lit(True)
            rows = F.sum(F.when(mine, F.col("_rows")))
            filled = F.sum(F.when(mine, F.col("_filled")))
            joined = F.when((rows != 1) | (filled != 0), joined)
        return joined.alias(column)

    return texts.groupBy(key).agg(*[merged(c) for c in columns])


def _within_width(texts, group, widths, sep):
    """Rows whose text, or the separator before it, starts within the cut width.

    A text takes at least one character and the separator, which bounds the
    row number and lets Spark limit each group before the shuffle; the running
    length then bounds the characters. Both are exact.
    """
    order = Window.partitionBy(*group).orderBy(F.col("_text").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    most = -(-(max(widths.values()) + len(sep)) // (1 + len(sep)))
    texts = texts.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") <= most)
    start = F.coalesce(F.sum(F.length("_text") + len(sep)).over(before), F.lit(0))
    width = F.lit(max(widths.values()))
    if "_col" in group:
        width = F.element_at(
            F.create_map(*[F.lit(v) for pair in widths.items() for v in pair]), F.col("_col")
        )
    return (
        texts.withColumn("_start", start)
        .where(F.col("_start") < width + len(sep))
        .drop("_nth", "_start")
    )


def merge_sources(source_item: DataFrame) -> DataFrame:
    """Source links of each entity in one text of any length.

    The result is one cell per entity by definition. Equal links collapse
    before the shuffle, so an entity costs its distinct links only.
    """
    return merge_text(source_item, KEY, {"SourceURI": None})


def merge_remarks(
    remark: DataFrame,
    null_if_single: bool = False,
    heavy: Heavy | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Remarks of each entity, each cut to 4000 characters, joined and cut again.

    Heavy entities are looked for unless a count with a frame ``remark`` is given.
    """
    if heavy is None:
        heavy = heavy_keys({"remark": remark}, policy)
    keys = heavy.keys("remark")
    salts = -(-keys.most // policy.rows_per_task) if keys else 1
    cut = remark.select(KEY, fit(F.col("Remark"), 4000).alias("Remark"))
    return merge_text(cut, KEY, {"Remark": 4000}, SEPARATOR, null_if_single, keys, salts)


def merge_national_ids(ident: DataFrame, null_if_single: bool = False) -> DataFrame:
    """National ids of each entity: numbers cut to 50, types cut to 85 after joining."""
    national = ident.where(F.col("IdentificationTypeDesc").startswith(NATIONAL_ID_PREFIX))
    return merge_text(
        national, KEY, {"IdentificationNumber": 50, "IdentificationTypeDesc": 85},
        null_if_single=null_if_single,
    )
