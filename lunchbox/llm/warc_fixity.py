"""Merkle fixity audit of WARC records in two replicas of an archive.

Pages become WARC response records, filed by ranges of ``PER_FILE`` page ids.  A record is stored in a file at an offset;
each replica lists what it holds (``stored``: file, offset, length and sha256 of every record), and its trees are built from that
list alone.  A leaf is an offset range of ``RANGE`` bytes of a file: the digest of offset, length and sha256 of the records that begin
there, in order of offset.  ``FANOUT`` neighbouring ranges make the node above them, up to the file's root, and the files' roots are
joined the same way up to one root.  The audit compares the two roots and goes down only into nodes that differ, level by level, to the
ranges with damage and the records in them: changed, missing, extra, or moved to another offset.  Every level is a
written table; a level has a sixteenth of the rows of the one below.

A lost record leaves its place empty and damages its own branch; a replica that closed the gap has moved all records after it, and they are
reported as moved.

Defined cases: null url or html is empty; records without page id are filed by a hash of their content, in files with negative numbers;
records that begin at one offset count together, in any order; equal records of a page id are matched one by one, by offset; equal
replicas give no rows; an empty replica gives a missing record for each; further columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from lunchbox.llm.runtime import freed, written

FANOUT_LOG, PER_FILE_LOG, RANGE_LOG = 4, 12, 16
FANOUT, PER_FILE, RANGE = 1 << FANOUT_LOG, 1 << PER_FILE_LOG, 1 << RANGE_LOG


def _record(url: str, html: str):
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), url, F.lit("\r\nContent-Length: "),
                    F.octet_length(html).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(head, html, F.lit("\r\n\r\n"))


def stored(pages: DataFrame, content: str = "html") -> DataFrame:
    """What a replica holds: number, page_id, file, offset, length and sha256 of every record.

    Records lie in a file in order of page id, each in the room that its page needs; ``content``: column of what is found there.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), text("url").alias("url"), text("html").alias("html"), text(content).alias("found"))
    rows = rows.withColumns({"room": _record("url", "html"), "record": _record("url", "found")})
    unnamed = -1 - F.pmod(F.xxhash64("room"), F.lit(PER_FILE * PER_FILE))
    rows = rows.withColumn("number", F.coalesce("page_id", unnamed)).select(
        "number", "page_id", F.shiftright("number", PER_FILE_LOG).alias("file"), F.octet_length("room").cast("long").alias("room"),
        F.octet_length("record").cast("long").alias("length"), F.sha2("record", 256).alias("sha256"))
    before = Window.partitionBy("file").orderBy("number", "sha256").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("offset", F.coalesce(F.sum("room").over(before), F.lit(0))).drop("room")


def tree(found: DataFrame, depth: int, file_depth: int) -> list[DataFrame]:
    """Levels (file, node, digest) from the ranges up to the files' roots, and on to the root of all files."""
    part = lambda k: F.sum(F.conv(F.substring("sha256", 1 + 16 * k, 15), 16, 10).cast("decimal(38,0)")).cast("string")
    # records that begin at one offset, usually one: sums, so that any number of them is one row
    places = found.groupBy("file", "offset").agg(F.concat_ws(",", F.col("offset").cast("string"), F.count("*").cast("string"), F.sum("length").cast("string"),
                                                             *(part(k) for k in range(4))).alias("entry"))
    leaves = places.groupBy("file", F.shiftright("offset", RANGE_LOG).alias("node")).agg(  # RANGE offsets at most
        F.sha2(F.concat_ws(";", F.transform(F.array_sort(F.collect_list(F.struct("offset", "entry"))), lambda r: r["entry"])), 256).alias("digest"))
    levels = [written(leaves, "leaves")]
    for level in range(depth + file_depth):
        inner = level < depth
        parent = [F.col("file") if inner else F.shiftright("file", FANOUT_LOG).alias("file"), F.shiftright("node", FANOUT_LOG).alias("node")]
        child = F.col("node") if inner else F.col("file")
        above = levels[-1].withColumn("child", child).groupBy(*parent).agg(F.array_sort(F.collect_list(F.struct("child", "digest"))).alias("children"))  # FANOUT at most
        digest = F.sha2(F.concat_ws(",", F.transform("children", lambda c: F.concat(c["child"].cast("string"), F.lit(":"), c["digest"]))), 256)
        levels.append(written(above.select("file", "node", digest.alias("digest")), "nodes"))
    return levels


def differing(ours: list[DataFrame], theirs: list[DataFrame], depth: int) -> DataFrame:
    """Ranges (file, node) that differ, found from the root down through differing nodes alone."""
    parents = None
    for level in range(len(ours) - 1, -1, -1):
        a, b = ours[level], theirs[level]
        if parents is not None:
            above = {"up_file": F.col("file") if level < depth else F.shiftright("file", FANOUT_LOG), "up_node": F.shiftright("node", FANOUT_LOG)}
            a, b = (x.withColumns(above).join(parents, ["up_file", "up_node"], "left_semi").drop("up_file", "up_node") for x in (a, b))
        both = a.join(b.withColumnRenamed("digest", "other"), ["file", "node"], "full_outer")
        wrong = written(both.where("not (digest <=> other)").select("file", "node"), "differing")
        parents = wrong.toDF("up_file", "up_node")
    return wrong


def _levels(reach: int) -> int:
    """Levels over numbers of this greatest size until one node is left (or two, of either sign)."""
    depth = 0
    while reach >> (FANOUT_LOG * depth) > 0:
        depth += 1
    return depth


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """Each damaged record of two ``stored`` lists: page_id, file, offset and length in the primary (of an extra one in the replica),
    kind, both digests, and its offset in the replica."""
    ours, theirs = (written(x, "records") for x in (primary, replica))
    low, high, most = ours.union(theirs).agg(F.min("file"), F.max("file"), F.max("offset")).first()
    depth, file_depth = _levels((most or 0) >> RANGE_LOG), _levels(max(abs(low or 0), abs(high or 0)) + 1)
    trees = tree(ours, depth, file_depth), tree(theirs, depth, file_depth)
    wrong = differing(*trees, depth)
    freed(*trees[0], *trees[1])
    a, b = (x.withColumn("node", F.shiftright("offset", RANGE_LOG)).join(wrong, ["file", "node"], "left_semi").drop("node") for x in (ours, theirs))

    def unmatched(a: DataFrame, b: DataFrame, match: list[str], order: str):
        """The rows of both that have no partner: the k-th of equal ones goes with the k-th."""
        nth = F.row_number().over(Window.partitionBy(*match).orderBy(order))
        a, b = a.withColumn("nth", nth), b.withColumn("nth", nth)
        pairs = a.join(b.select(*match, "nth", F.col("offset").alias("replica_offset") if "offset" not in match else F.lit(None).alias("replica_offset")),
                       [*match, "nth"])
        return a.join(b, [*match, "nth"], "left_anti").drop("nth"), b.join(a, [*match, "nth"], "left_anti").drop("nth"), pairs

    a, b, _ = unmatched(a, b, ["number", "sha256", "length", "file", "offset"], "sha256")
    a, b = written(a, "lost"), written(b, "added")
    a, b, same = unmatched(a, b, ["number", "sha256", "length", "file"], "offset")
    moved = same.select("page_id", "file", "offset", "length", F.lit("moved").alias("kind"), F.col("sha256").alias("a"), F.col("sha256").alias("b"), "replica_offset")
    rank = F.row_number().over(Window.partitionBy("number").orderBy("sha256", "offset"))  # records of one page id that differ
    columns = ("page_id", "file", "offset", "length", "sha256")
    mine = a.select("number", rank.alias("rank"), *(F.col(c).alias(f"a_{c}") for c in columns))
    other = b.select("number", rank.alias("rank"), *(F.col(c).alias(f"b_{c}") for c in columns))
    both = mine.join(other, ["number", "rank"], "full_outer")
    kind = F.when(F.col("b_sha256").isNull(), "missing").when(F.col("a_sha256").isNull(), "extra").otherwise("changed")
    rest = both.select(*(F.coalesce(f"a_{c}", f"b_{c}").alias(c) for c in columns[:4]), kind.alias("kind"), "a_sha256", "b_sha256", "b_offset")
    return rest.union(moved).toDF("page_id", "warc_file", "record_offset", "record_length", "kind", "primary_sha256", "replica_sha256", "replica_offset")


def damaged_replica(pages: DataFrame) -> DataFrame:
    """What a damaged replica holds: of each 97 page ids one lost, one cut off by a character, one altered and one seven bytes further on."""
    kind = F.coalesce(F.pmod(F.col("page_id"), F.lit(97)), F.lit(0))
    html = F.when(kind == 6, F.expr("substring(html, 1, length(html) - 1)")).when(kind == 5, F.concat(F.lit("?"), F.expr("substring(html, 2)"))).otherwise(F.col("html"))
    held = stored(pages.select("page_id", "url", "html", html.alias("found")), "found")
    return held.where(kind != 7).withColumn("offset", F.when(kind == 8, F.col("offset") + 7).otherwise(F.col("offset")))


#: The damage of ``damaged_replica``, found by comparing all records.
SQL = """
WITH p AS (
  SELECT page_id, CAST(floor(page_id / 4096.0) AS BIGINT) AS warc_file,
         'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10)
           || 'Content-Length: ' AS head, html
  FROM pages
), r AS (
  SELECT page_id, warc_file, page_id % 97 AS k,
         head || strlen(html) || repeat(chr(13) || chr(10), 2) || html || repeat(chr(13) || chr(10), 2) AS rec,
         CASE page_id % 97 WHEN 6 THEN substring(html, 1, length(html) - 1) WHEN 5 THEN '?' || substring(html, 2) END AS bad, head
  FROM p
), o AS (
  SELECT *, strlen(rec) AS record_length,
         coalesce(sum(strlen(rec)) OVER (PARTITION BY warc_file ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS record_offset
  FROM r
)
SELECT page_id, warc_file, CAST(record_offset AS BIGINT) AS record_offset, CAST(record_length AS BIGINT) AS record_length,
       CASE k WHEN 7 THEN 'missing' WHEN 8 THEN 'moved' ELSE 'changed' END AS kind, sha256(rec) AS primary_sha256,
       CASE WHEN k = 8 THEN sha256(rec) WHEN k <> 7 THEN sha256(head || strlen(bad) || repeat(chr(13) || chr(10), 2) || bad || repeat(chr(13) || chr(10), 2)) END AS replica_sha256,
       CASE WHEN k <> 7 THEN CAST(record_offset + CASE WHEN k = 8 THEN 7 ELSE 0 END AS BIGINT) END AS replica_offset
FROM o WHERE k IN (5, 6, 7, 8)
"""
