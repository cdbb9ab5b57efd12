"""Column rules and keyed joins of cell and transcript tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Names under which a table may keep the id of a cell, in the order in which they are tried.
ID_COLUMNS = ("cell_id", "assignment", "cell", "EntityID", "CELL_ID")


def tagged(rows: DataFrame, tags: dict[str, str], cell: str = "cell_id") -> DataFrame:
    """``rows`` with constant columns and ``index``: the tags and the cell's id joined by dots."""
    out = rows.withColumns({name: F.lit(value) for name, value in tags.items()})
    return out.withColumn("index", F.concat_ws(".", *tags, F.col(cell).cast("string")))


def preset(rows: DataFrame, names: dict[str, str], wanted: list[str], optional: tuple[str, ...] = ()) -> DataFrame:
    """Columns renamed where they exist, then ``wanted`` and those of ``optional`` that are there."""
    out = rows.withColumnsRenamed({a: b for a, b in names.items() if a in rows.columns})
    return out.select(*wanted, *[c for c in optional if c in out.columns])


def affine(rows: DataFrame, m: list[list[float]], x: str = "x", y: str = "y") -> DataFrame:
    """Points under a 3 x 3 matrix."""
    return rows.withColumns({x: m[0][0] * F.col(x) + m[0][1] * F.col(y) + m[0][2], y: m[1][0] * F.col(x) + m[1][1] * F.col(y) + m[1][2]})


def inverse(m: list[list[float]]) -> list[list[float]]:
    """The inverse of an affine 3 x 3 matrix."""
    (a, b, tx), (d, e, ty) = m[0], m[1]
    det = a * e - b * d
    if not det:
        raise ValueError("the matrix has no inverse")
    return [[e / det, -b / det, (b * ty - e * tx) / det], [-d / det, a / det, (d * tx - a * ty) / det], [0.0, 0.0, 1.0]]


def renamed_genes(rows: DataFrame, names: dict[str, str], gene: str = "gene") -> DataFrame:
    """Genes by their new names; those without one keep theirs."""
    if not names:
        return rows
    return rows.withColumn(gene, F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), F.col(gene)), F.col(gene)))


def lab_names(sample: Column, lab: str) -> tuple[Column, Column]:
    """(experiment, region) from a sample's name ``..._<experiment>`` and ``..._<region>``, by the rules of either lab."""
    part = F.split_part(sample, F.lit("_"), F.lit(2))
    if lab == "ucsd":
        return F.substring_index(part, "BICAN", -1), F.split_part(part, F.lit("Q0"), F.lit(1))
    pieces = F.split(part, "-")
    last, before = F.try_element_at(pieces, F.lit(-2)), F.try_element_at(pieces, F.lit(-3))
    first = F.element_at(pieces, 1)
    return F.when(F.length(last) == 1, before).otherwise(last), F.when(F.length(first) == 3, F.array_join(F.slice(pieces, 1, 2), "")).otherwise(first)


def is_blank(gene: Column, rule: str) -> Column:
    """Blank probes by one of the rules in use: ``any`` (any case, anywhere), ``start`` (``Blank-`` in front) or ``inside`` (``Blank-`` anywhere)."""
    return {"any": F.contains(F.lower(gene), F.lit("blank")), "start": gene.startswith("Blank-"), "inside": F.contains(gene, F.lit("Blank-"))}[rule]


def soma_flag(rows: DataFrame, cell: str) -> Column:
    """Whether a point is in a cell: a number over 0, or any text."""
    numeric = dict(rows.dtypes)[cell] not in ("string", "boolean")
    return F.coalesce(F.col(cell) > 0, F.lit(False)) if numeric else F.col(cell).isNotNull()


def unassigned(points: DataFrame, cell: str, keep: DataFrame) -> DataFrame:
    """``points`` whose cell is not in ``keep`` (column ``cell``) get -1, as a number or text."""
    kind = dict(points.dtypes)[cell]
    marks = keep.select(F.col(cell).cast(kind).alias(cell), F.lit(True).alias("kept_cell")).distinct()
    out = points.join(marks, cell, "left")
    return out.withColumn(cell, F.when(F.col("kept_cell"), F.col(cell)).otherwise(F.lit("-1").cast(kind))).select(*points.columns)


def id_column(columns: list[str], asked: str | None = None, instance: str | None = None) -> str:
    """The asked column, else the instance key, else the first known name that is there."""
    for name in (asked, instance, *ID_COLUMNS):
        if name and name in columns:
            return name
    raise ValueError(f"none of {ID_COLUMNS} is a column")


def alpha_beta(mean: Column, kappa: Column) -> tuple[Column, Column]:
    """Parameters of a beta distribution from its mean and concentration."""
    return mean * kappa, (1 - mean) * kappa


def obs_or_gene(obs: DataFrame, counts: DataFrame, name: str) -> DataFrame:
    """(cell_id, value): a numeric column of ``obs``, else the counts of a gene, 0 where a cell has none."""
    if name in obs.columns:
        return obs.select("cell_id", F.col(name).cast("double").alias("value"))
    gene = counts.where(F.col("gene") == name).groupBy("cell_id").agg(F.sum("count").cast("double").alias("value"))
    return obs.select("cell_id").join(gene, "cell_id", "left").fillna(0.0, ["value"])


def passing(cells: DataFrame) -> DataFrame:
    """Cells with ``pass_qc`` (true where the column is missing) that are no doublets."""
    out = cells.where("pass_qc") if "pass_qc" in cells.columns else cells
    return out.where("NOT doublet_bool") if "doublet_bool" in cells.columns else out


def confident(points: DataFrame, least: float = 0.5) -> DataFrame:
    """Transcripts of a probability over ``least`` outside the background, with coordinates rounded half to even at two digits."""
    return points.where((F.col("probability") > least) & (F.col("background") == 0)).withColumns({c: F.bround(c, 2) for c in ("x", "y")})


def voxel_anisotropy(micron_per_z: float, xy: float, scale: float = 1.0) -> float:
    """Height of a voxel over its width."""
    return micron_per_z / (xy * scale)


def with_defaults(cells: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Missing columns with a default; those that are there stay as they are."""
    return cells.withColumns({c: F.lit(v) for c, v in defaults.items() if c not in cells.columns})


def in_box(rows: DataFrame, minx: float, miny: float, maxx: float, maxy: float) -> DataFrame:
    """Points inside a box, or shapes (minx..maxy) whose bounds meet it; both with the edge."""
    if "minx" in rows.columns:
        return rows.where((F.col("minx") <= maxx) & (F.col("maxx") >= minx) & (F.col("miny") <= maxy) & (F.col("maxy") >= miny))
    return rows.where(F.col("x").between(minx, maxx) & F.col("y").between(miny, maxy))


def around_cell(rows: DataFrame, cells: DataFrame, cell_id: object, margin: float = 10.0) -> DataFrame:
    """Rows inside the bounds of one cell, widened by ``margin``."""
    b = cells.where(F.col("entity_id") == cell_id).agg(*[F.min(c).alias(c) for c in ("minx", "miny")], *[F.max(c).alias(c) for c in ("maxx", "maxy")]).first()
    return rows.limit(0) if b["minx"] is None else in_box(rows, b["minx"] - margin, b["miny"] - margin, b["maxx"] + margin, b["maxy"] + margin)


def merged_back(rows: DataFrame, old: DataFrame, key: str, suffix: str = "_old") -> DataFrame:
    """Inner join on ``key``; columns that both have come from ``rows``, and columns with ``suffix`` in their name are dropped."""
    rest = old.select(key, *[c for c in old.columns if c != key and c not in rows.columns])
    out = rows.join(rest, key)
    return out.select(*[c for c in out.columns if suffix not in c])


def with_signals(metadata: DataFrame, signals: DataFrame, key: str, how: str = "left", signal_key: str | None = None, shift: int = 0) -> DataFrame:
    """Metadata joined with signals on ``key``; the signals' own key may have another name and start at another number."""
    right = signals.withColumn(key, F.col(signal_key or key) + shift) if shift or signal_key else signals
    return metadata.join(right.drop(*([signal_key] if signal_key and signal_key != key else [])), key, how)


def with_user_columns(rows: DataFrame, user: DataFrame, crosswalk: DataFrame, user_key: str, key: str, suffix: str = "_user") -> DataFrame:
    """User metadata brought to the cells' ids by a crosswalk (user_key, key), then joined on the left; clashing names get a suffix."""
    mapped = user.join(crosswalk, user_key)
    return rows.join(mapped.select(key, *[F.col(c).alias(c + suffix if c in rows.columns else c) for c in mapped.columns if c != key]), key, "left")


def matched_coordinates(left: DataFrame, right: DataFrame, digits: int = 2) -> DataFrame:
    """Left join on coordinates rounded half to even; points at one place multiply."""
    on = lambda df: df.withColumns({"rx": F.bround("x", digits), "ry": F.bround("y", digits)})
    rest = on(right).select("rx", "ry", *[c for c in right.columns if c not in left.columns])
    return on(left).join(rest, ["rx", "ry"], "left").drop("rx", "ry")


def transferred(cells: DataFrame, notes: DataFrame, names: list[str], key: str = "cell_id") -> DataFrame:
    """Annotation columns by the text of the cell's id; null where there is none."""
    right = notes.select(F.col(key).cast("string").alias("text_key"), *[F.col(n) for n in names]).dropDuplicates(["text_key"])
    return cells.drop(*names).join(right, F.col(key).cast("string") == F.col("text_key"), "left").drop("text_key")


def channel_rows(table: DataFrame, wanted: list[str], name: str = "channel") -> DataFrame:
    """Rows of the wanted channels in their order, in ``position``; a channel that is missing is an error."""
    spark = table.sparkSession
    order = spark.createDataFrame([(c, i) for i, c in enumerate(wanted)], f"{name} string, position int")
    missing = [r[0] for r in order.join(table, name, "left_anti").select(name).collect()]  # of the wanted ones only
    if missing:
        raise ValueError(f"channels not found: {missing}")
    return table.join(F.broadcast(order), name)


def shared_genes(*tables: DataFrame) -> DataFrame:
    """(gene) in every table, so that a reference can be cut before it is loaded in full."""
    genes = [t.select("gene").distinct() for t in tables]
    return reduce(lambda a, b: a.join(b, "gene", "left_semi"), genes)


def stacked(tables: list[DataFrame], outer: bool = False) -> DataFrame:
    """Union of tables on the columns that all have, or with nulls on all columns."""
    if outer:
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    shared = [c for c in tables[0].columns if all(c in t.columns for t in tables)]
    return reduce(DataFrame.unionByName, [t.select(*shared) for t in tables])


def with_experiment_ids(rows: DataFrame, experiment: str = "experiment", region: str = "region") -> DataFrame:
    """``brain_region``, ``donor``, ``replicate`` and ``dataset_id`` from the names of experiment and region."""
    part = lambda c, i: F.split_part(F.col(c), F.lit("_"), F.lit(i))
    out = rows.withColumns({"brain_region": part(experiment, 1), "donor": part(region, 1), "replicate": F.nullif(part(region, 2), F.lit(""))})
    return out.withColumn("dataset_id", F.concat_ws("_", "brain_region", "donor", "replicate"))


def embedding_columns(rows: DataFrame, vector: str, prefix: str, n: int) -> DataFrame:
    """The first ``n`` components of a vector as columns ``prefix_1`` and so on."""
    return rows.withColumns({f"{prefix}_{i + 1}": F.get(vector, i) for i in range(n)})
