"""Merkle fixity audit of WARC replicas.

A replica is laid out as WARC files; each record is hashed, and so is each
range of offsets over the records that start in it, ``FANOUT`` ranges into one,
up to a root per file. Replicas are compared at their roots, and only below
differing nodes level by level down to the records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from curbflow.session import cut_lineage

RECORDS_PER_FILE = 200
RANGE_BYTES, FANOUT = 1 << 15, 4


def file_of(page_id: Column, url: Column, files: int) -> Column:
    """A file by the record's id, the same in every replica."""
    name = F.coalesce(page_id.cast("string"), url, F.lit(""))
    return (F.conv(F.substring(F.md5(name), 1, 7), 16, 10).cast("int") % files).alias("file")


def warc_record(page_id: Column, url: Column, html: Column) -> Column:
    """The record as text: header, page, two line ends. Null parts are empty."""
    body = F.coalesce(html, F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"),
    )


def layout(pages: DataFrame, files: int, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Rows (file, page_id, nth, sha, length, copies, offset): the records of a replica where they stand in its files.

    Records stand in order of id, then hash; nth tells records of one id apart. Equal records are one row with
    their number of copies, which stand one after another."""
    page = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    record = warc_record(F.col("page_id"), F.col("url"), F.col("html"))
    records = page.select(
        file_of(F.col("page_id"), F.col("url"), files), "page_id", F.sha2(record, 256).alias("sha"), F.octet_length(record).cast("long").alias("length")
    )
    counted = records.groupBy("file", "page_id", "sha", "length").agg(F.count("*").alias("copies"))
    in_file = Window.partitionBy("file").orderBy(F.asc_nulls_first("page_id"), "sha", "length")
    before = F.coalesce(F.sum(F.col("length") * F.col("copies")).over(in_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    of_id = Window.partitionBy("file", "page_id").orderBy("sha", "length")
    return counted.withColumn("offset", before).withColumn("nth", F.row_number().over(of_id))


def write_warc(pages: DataFrame, folder: str, files: int) -> None:
    """Write the replica itself, one Spark part a file, records in the order of ``layout``."""
    page_id, url, html = (F.col(n) for n in ("page_id", "url", "html"))
    record = warc_record(page_id, url, html)
    # The writer adds the last line end of each record.
    rows = pages.withColumn("record", record).select(file_of(page_id, url, files), "page_id", F.expr("left(record, length(record) - 2)").alias("value"), F.sha2(record, 256).alias("sha"))
    ordered = rows.repartition("file").sortWithinPartitions("file", F.asc_nulls_first("page_id"), "sha")
    ordered.select("file", "value").write.partitionBy("file").option("lineSep", "\r\n").text(folder)


class Replica:
    """The records of a replica and its trees, level 0 being the ranges of ``range_bytes``."""

    def __init__(self, records: DataFrame, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT):
        self.records = cut_lineage(records.withColumn("node", F.floor(F.col("offset") / range_bytes).cast("long")))
        self.fanout = fanout
        self.levels = [
            cut_lineage(self._hashed(self.records.select("file", "node", F.struct("offset", "copies", "sha").alias("part"))))
        ]

    @staticmethod
    def _hashed(parts: DataFrame) -> DataFrame:
        """One digest a node over its parts in order; a node has no more parts than fit its range or the fanout."""
        text = F.array_join(F.transform(F.array_sort(F.collect_list("part")), lambda p: F.to_csv(p)), "\n")
        return parts.groupBy("file", "node").agg(F.sha2(text, 256).alias("digest"))

    def height(self) -> int:
        """Levels above the lowest until every file has a single node."""
        most = self.levels[0].agg(F.max("node")).first()[0] or 0
        levels = 0
        while most:
            most //= self.fanout
            levels += 1
        return levels

    def build(self, height: int) -> Replica:
        while len(self.levels) <= height:
            above = self.levels[-1].select("file", F.expr(f"node div {self.fanout}").alias("node"), F.struct(F.col("node").alias("below"), "digest").alias("part"))
            self.levels.append(cut_lineage(self._hashed(above)))
        return self


def differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """Nodes (file, node) whose digests differ, or that one side lacks."""
    sides = a.withColumnRenamed("digest", "digest_a").join(b.withColumnRenamed("digest", "digest_b"), ["file", "node"], "full")
    return sides.where(~F.col("digest_a").eqNullSafe(F.col("digest_b"))).select("file", "node")


def audit(a: DataFrame, b: DataFrame, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT) -> DataFrame:
    """Records that differ between two layouts, found from the roots down.

    Columns: file, page_id, nth, status (altered, missing from b, extra in b, moved), and offset, length, sha and
    copies on either side. Equal replicas and empty tables give no rows. Records without id are told apart by nth
    like other records of one id.
    """
    left, right = Replica(a, range_bytes, fanout), Replica(b, range_bytes, fanout)
    height = max(left.height(), right.height())
    left.build(height), right.build(height)
    wrong = cut_lineage(differing(left.levels[height], right.levels[height]))
    for level in range(height - 1, -1, -1):
        above = wrong.withColumnRenamed("node", "above")
        below = [
            side.levels[level].withColumn("above", F.expr(f"node div {fanout}")).join(above, ["file", "above"], "left_semi").drop("above")
            for side in (left, right)
        ]
        wrong = cut_lineage(differing(*below))
    suspects = [side.records.join(wrong, ["file", "node"], "left_semi").drop("node") for side in (left, right)]
    x, y = (s.select("file", "page_id", "nth", *(F.col(n).alias(f"{n}_{tag}") for n in ("offset", "length", "sha", "copies"))) for s, tag in zip(suspects, "ab"))
    y = y.withColumnsRenamed({n: f"y_{n}" for n in ("file", "page_id", "nth")})
    same = (x.file == y.y_file) & x.page_id.eqNullSafe(y.y_page_id) & (x.nth == y.y_nth)
    pairs = x.join(y, same, "full")
    changed = (F.col("sha_a") != F.col("sha_b")) | (F.col("copies_a") != F.col("copies_b"))
    status = (
        F.when(F.col("sha_b").isNull(), "missing").when(F.col("sha_a").isNull(), "extra")
        .when(changed, "altered").when(F.col("offset_a") != F.col("offset_b"), "moved")
    )
    both = lambda n: F.coalesce(n, f"y_{n}").alias(n)
    sides = [f"{n}_{tag}" for tag in "ab" for n in ("offset", "length", "sha", "copies")]
    return pairs.select(both("file"), both("page_id"), both("nth"), status.alias("status"), *sides).where("status is not null")


def damaged(pages: DataFrame) -> DataFrame:
    """A replica as it may come back from a bad disk: by the id's hash, some pages have a wrong first character and few are gone."""
    mark = F.md5(F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    html = F.when(mark.endswith("a5"), F.concat(F.lit("#"), F.substring("html", 2, 2_000_000_000))).otherwise(F.col("html"))
    return pages.where(~mark.endswith("00f")).withColumn("html", html)


def audit_of_pages(pages: DataFrame) -> DataFrame:
    """Lay the pages out, damage a replica of them, and audit it against the original."""
    pages = pages.select("page_id", "url", "html")
    files = max(1, -(-pages.count() // RECORDS_PER_FILE))
    return audit(layout(pages, files), layout(damaged(pages), files))


def _side(rows: str) -> str:
    record = (
        "concat('WARC/1.1', chr(13), chr(10), 'WARC-Type: resource', chr(13), chr(10), 'WARC-Record-ID: <urn:page:', coalesce(cast(page_id as varchar), ''), "
        "'>', chr(13), chr(10), 'WARC-Target-URI: ', coalesce(url, ''), chr(13), chr(10), 'Content-Type: text/html', chr(13), chr(10), 'Content-Length: ', "
        "cast(strlen(coalesce(html, '')) as varchar), chr(13), chr(10), chr(13), chr(10), coalesce(html, ''), chr(13), chr(10), chr(13), chr(10))"
    )
    return f"""
select *, coalesce(sum(length * copies) over (partition by file order by page_id nulls first, sha, length rows between unbounded preceding and 1 preceding), 0) as place,
  row_number() over (partition by file, page_id order by sha, length) as nth
from (
  select file, page_id, sha256(record) as sha, cast(strlen(record) as bigint) as length, count(*) as copies
  from (
    select page_id, {record} as record,
      cast('0x' || substr(md5(coalesce(cast(page_id as varchar), url, '')), 1, 7) as integer) % (select greatest(1, cast(ceil(count(*) / {RECORDS_PER_FILE}.0) as integer)) from pages) as file
    from ({rows})
  ) group by all
)"""


ORACLE = f"""
with a as ({_side("select page_id, url, html from pages")}), b as ({_side('''
  select page_id, url, case when md5(coalesce(cast(page_id as varchar), '')) like '%a5' then '#' || substr(html, 2) else html end as html
  from pages where md5(coalesce(cast(page_id as varchar), '')) not like '%00f' ''')})
select * from (
  select coalesce(a.file, b.file) as file, coalesce(a.page_id, b.page_id) as page_id, cast(coalesce(a.nth, b.nth) as integer) as nth,
    case when b.sha is null then 'missing' when a.sha is null then 'extra' when a.sha <> b.sha or a.copies <> b.copies then 'altered'
      when a.place <> b.place then 'moved' end as status,
    cast(a.place as bigint) as offset_a, a.length as length_a, a.sha as sha_a, a.copies as copies_a,
    cast(b.place as bigint) as offset_b, b.length as length_b, b.sha as sha_b, b.copies as copies_b
  from a full join b on a.file = b.file and a.page_id is not distinct from b.page_id and a.nth = b.nth
) where status is not null
"""
