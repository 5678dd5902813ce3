"""Merkle fixity audit of WARC archives.

Pages are serialised as WARC records and laid out one after the other in archives: those that a column names, else of
FANOUT ** LEVELS records each.
A leaf is the hash of a record's offset range and hash; a node is the hash of its FANOUT children in offset order, with
their ranges; levels are added until the largest archive of either replica has one root. Two replicas, each with a layout of its own, are compared from their roots;
only the children of nodes that differ or lack a partner are compared on the next level, down to the records. Places that
differ are told apart by what lies there: a record that the other replica has elsewhere in the archive is moved, one of
the same id and url but other content is corrupt, else it is missing or extra.

Positions come from a range partitioning on (id, url, hash) and counts by partition, so no archive, id or url
gathers in one task. Defined results: records that agree in id, url and content are one record with `copies`; a
null html is an empty body, a null url an empty target, a null id comes first; an empty table has no archive.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, written

#: Children of a node; levels of the trees of archives that no column names, which bounds their records.
FANOUT, LEVELS = 16, 3


#: Pages have no date of their own; records must have one.
DATE = "1970-01-01T00:00:00Z"


def record(page_id: Column, url: Column, html: Column) -> Column:
    """A WARC/1.0 resource record. Line ends in a url are percent-encoded, so that none ends its header."""
    body = F.coalesce(html, F.lit(""))
    url = F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(f">\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"),
    )


def layout(pages: DataFrame, replica: Column | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", archive: Column | None = None) -> DataFrame:
    """page_id, url, archive, seq, offset, length, copies, sha256 of every record. archive: an expression on page_id and
    url for the number of a record's archive (null: -1). replica: one on page_id, url and html for the body that a
    replica of the same layout has at that place; then also replica_sha256."""
    rows = pick(pages, page_id=id_col, url=url_col, html=html_col).select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    one = record(F.col("page_id"), F.col("url"), F.col("html"))
    two = record(F.col("page_id"), F.col("url"), F.col("html") if replica is None else replica)
    rows = rows.select("page_id", "url", F.octet_length(one).cast("long").alias("length"), F.sha2(one, 256).alias("sha256"), F.sha2(two, 256).alias("replica_sha256"))
    rows = rows.groupBy("page_id", "url", "sha256").agg(F.min("length").alias("length"), F.min("replica_sha256").alias("replica_sha256"), F.count("*").alias("copies"))
    order = ["page_id", "url", "sha256"]
    if archive is not None:
        return _in_archives(rows.withColumn("archive", F.coalesce(archive.cast("long"), F.lit(-1))), ["archive", *order])
    dealt = written(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "records")
    ranked = dealt.withColumn("place", F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1)
    sizes = dealt.groupBy("part").agg(F.count("*").alias("n"))  # a row for each partition
    starts = sizes.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    full = FANOUT**LEVELS
    placed = ranked.join(F.broadcast(starts), "part").withColumn("at", F.col("before") + F.col("place"))
    placed = placed.withColumn("archive", F.floor(F.col("at") / full).cast("long")).withColumn("seq", (F.col("at") % full).cast("int"))
    before = Window.partitionBy("archive").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select("page_id", "url", "archive", "seq", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long").alias("offset"), "length", "copies", "sha256", "replica_sha256")


def _in_archives(rows: DataFrame, order: list[str]) -> DataFrame:
    """Places within given archives, by counts and bytes by partition: a large archive may lie in many."""
    dealt = written(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "records")
    here, earlier = Window.partitionBy("archive", "part").orderBy(*order), Window.partitionBy("archive").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("archive", "part").agg(F.count("*").alias("n"), F.sum("length").alias("bytes"))
    starts = sizes.select("archive", "part", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("n", "bytes")])
    placed = dealt.withColumn("place", F.row_number().over(here) - 1).withColumn("behind", F.coalesce(F.sum("length").over(here.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = placed.join(written(starts, "starts"), ["archive", "part"])
    seq, offset = (F.col("n_before") + F.col("place")).cast("int"), (F.col("bytes_before") + F.col("behind")).cast("long")
    return placed.select("page_id", "url", "archive", seq.alias("seq"), offset.alias("offset"), "length", "copies", "sha256", "replica_sha256")


def levels(*layouts: DataFrame) -> int:
    """Levels above the leaves until each archive has one node."""
    last = max([0, *[x.agg(F.max("seq")).first()[0] or 0 for x in layouts]])
    up = 1
    while last >= FANOUT**up:
        up += 1
    return up


def nodes(leaves: DataFrame, digest: str, up: int | None = None, keep: Callable[[DataFrame], DataFrame] = lambda level: level) -> list[DataFrame]:
    """Levels of the trees, leaves first: archive, node, offset, length, digest. up: levels above the leaves. keep: what is
    done to a level before the next is made from it."""
    text = F.concat_ws(":", F.col("offset").cast("string"), F.col("length").cast("string"), F.col(digest))
    level = leaves.select("archive", F.col("seq").alias("node"), "offset", "length", F.sha2(text, 256).alias("digest"))
    out = [level]
    for _ in range(up or levels(leaves)):
        child = F.struct("offset", "length", "digest")
        level = level.groupBy("archive", F.floor(F.col("node") / FANOUT).cast("int").alias("node")).agg(F.sort_array(F.collect_list(child)).alias("children"))
        text = F.array_join(F.transform("children", lambda c: F.concat_ws(":", c["offset"].cast("string"), c["length"].cast("string"), c["digest"])), "\n")
        total = F.aggregate("children", F.lit(0).cast("long"), lambda a, c: a + c["length"])
        level = level.select("archive", "node", F.col("children")[0]["offset"].alias("offset"), total.alias("length"), F.sha2(text, 256).alias("digest"))
        level = keep(level)
        out.append(level)
    return out


def corrupt(one: list[DataFrame], two: list[DataFrame]) -> DataFrame:
    """archive, seq of the records in which two replicas' trees differ, found from the roots down. A node that only
    one of them has differs."""
    suspects = None
    for a, b in zip(reversed(one), reversed(two), strict=True):
        a, b = a.select("archive", "node", F.col("digest").alias("mine")), b.select("archive", "node", F.col("digest").alias("other"))
        if suspects is not None:
            parents = suspects.select(F.col("archive"), F.col("node").alias("parent"))
            a, b = (x.withColumn("parent", F.floor(F.col("node") / FANOUT).cast("int")).join(parents, ["archive", "parent"], "left_semi").drop("parent") for x in (a, b))
        differ = a.join(b, ["archive", "node"], "full_outer").where(~F.col("mine").eqNullSafe(F.col("other")))
        suspects = written(differ.select("archive", "node"), "suspects")
    return suspects.withColumnRenamed("node", "seq")


def _tree(leaves: DataFrame, digest: str, up: int) -> list[DataFrame]:
    return nodes(leaves, digest, up, lambda level: written(level, "nodes"))


def _paired(mine: DataFrame, theirs: DataFrame, by: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows that agree in `by`, nulls too, and what is left of either."""
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"replica_{c}"))
    return mine.join(theirs, same), mine.join(theirs, same, "left_anti"), theirs.join(mine, same, "left_anti")


def _alone(rows: DataFrame, by: list[str]) -> DataFrame:
    """The rows that alone have their values of `by`."""
    once = rows.groupBy(*[F.col(c).alias(f"_{c}") for c in by]).agg(F.count("*").alias("_n")).where("_n = 1")
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return rows.join(once, same, "left_semi")


_PLACE = ["archive", "page_id", "url", "seq", "offset", "length", "copies", "sha256"]


def audit(leaves: DataFrame, replica: DataFrame | None = None) -> DataFrame:
    """The layout with status: ok or corrupt. replica: the layout of a second replica, with its own offsets, lengths and
    hashes. Then every record of either is a row, with replica_seq, replica_offset, replica_length and replica_sha256;
    status is also moved (elsewhere in the archive), missing (the replica has no such record) or extra (only it has)."""
    if replica is None:
        leaves = written(leaves, "leaves")
        up = levels(leaves)
        bad = corrupt(_tree(leaves, "sha256", up), _tree(leaves, "replica_sha256", up)).withColumn("bad", F.lit(True))
        return leaves.join(bad, ["archive", "seq"], "left").withColumn("status", F.when(F.col("bad"), "corrupt").otherwise("ok")).drop("bad")
    mine, other = written(leaves.select(_PLACE), "leaves"), written(replica.select(_PLACE), "leaves")
    up = levels(mine, other)
    bad = corrupt(_tree(mine, "sha256", up), _tree(other, "sha256", up))
    theirs = other.select(*[F.col(c).alias(f"replica_{c}") for c in _PLACE])
    ok = _paired(mine.join(bad, ["archive", "seq"], "left_anti").select(_PLACE), theirs, ["archive", "seq"])[0].withColumn("status", F.lit("ok"))
    left = written(mine.join(bad, ["archive", "seq"], "left_semi").select(_PLACE), "suspects")
    right = written(other.join(bad, ["archive", "seq"], "left_semi").select(*[F.col(c).alias(f"replica_{c}") for c in _PLACE]), "suspects")
    out = [ok]
    for status, by in (("moved", ["archive", "page_id", "url", "sha256"]), ("corrupt", ["archive", "page_id", "url", "seq"])):
        pairs, left, right = _paired(left, right, by)
        out.append(pairs.withColumn("status", F.lit(status)))
        left, right = written(left, "suspects"), written(right, "suspects")
    who = ["archive", "page_id", "url"]
    pairs = written(_paired(_alone(left, who), _alone(right, [f"replica_{c}" for c in who]), who)[0], "pairs")
    out.append(pairs.withColumn("status", F.lit("corrupt")))
    out.append(left.join(pairs.select("archive", "seq"), ["archive", "seq"], "left_anti").withColumn("status", F.lit("missing")))
    out.append(right.join(pairs.select("replica_archive", "replica_seq"), ["replica_archive", "replica_seq"], "left_anti").withColumn("status", F.lit("extra")))
    rows = out[0]
    for x in out[1:]:
        rows = rows.unionByName(x, allowMissingColumns=True)
    for c in ("archive", "page_id", "url"):
        rows = rows.withColumn(c, F.when(F.col("status") == "extra", F.col(f"replica_{c}")).otherwise(F.col(c)))
    return rows.select(*_PLACE, "replica_seq", "replica_offset", "replica_length", "replica_sha256", "status")
