"""Reports kept up to date by partial sums.

Each report over the facts is a sum by some keys that then meets the current
rows of the dimensions. The sums of a batch are its own facts' sums, and those of
a delete are the deleted facts' with the other sign; adding up the sums of all
batches gives the sums of the facts that are left. So a batch costs a scan of
its own folder, a delete a scan of the files it marks rows in, and a report a
scan of the sums, which hold a row for each key and batch, not for each fact. The
kinds of sums are kept and committed apart, so a warehouse sums what its reports ask for. A
compaction changes no sum. Attributes are taken from the dimensions when a report
is read, so their changes need no retraction.
"""

from __future__ import annotations

from collections.abc import Collection
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidestar.plans import analytics
from tidestar.plans.warehouse import BITMAP_BITS, BROADCAST_BITMAPS, Warehouse
from tidestar.schemas import star_schema

# Keys of each kind of sum. The quarter follows from the date.
QUARTER = "cast(date_sk / 10000 AS INT) * 10 + cast(ceil(cast(date_sk / 100 AS INT) % 100 / 3) AS INT)"
KEYS = {"days": ["date_sk"], "quarters": ["quarter_sk", "product_key"], "pairs": ["customer_key", "product_key"]}
_SUMS = {"n": "count(1)", "amount": "sum(total_amount)", "listed": "sum(cast(quantity * unit_price AS decimal(12,2)))"}
_SCHEMA = "n bigint, amount decimal(38,2), listed decimal(38,2), _batch_id bigint"


class ReportSums:
    """Partial sums of a warehouse's facts, in folders of its batches. ``kinds`` are the sums that a refresh keeps up, all by default."""

    def __init__(self, warehouse: Warehouse, kinds: Collection[str] = tuple(KEYS)) -> None:
        self.warehouse, self.kinds = warehouse, tuple(kinds)
        if unknown := set(self.kinds) - set(KEYS):
            raise ValueError(f"no such sums: {sorted(unknown)}")

    def _path(self, kind: str) -> str:
        return f"{self.warehouse.root}/report_sums/{kind}"

    def _summed(self, kind: str) -> DataFrame:
        """Batches of which there are sums of a kind. An entry without a kind stands for all kinds."""
        return self.warehouse.commits().where(F.col("table_name").isin("report_sums", f"report_sums_{kind}")).select("batch_id")

    def _missing(self) -> dict[int, list[str]]:
        """Batches that added or deleted facts, each with the kinds that are not summed yet."""
        own = self.warehouse.commits().where("table_name IN ('fact_orders', 'fact_vectors') AND rows > 0").select("batch_id").distinct()
        missing: dict[int, list[str]] = {}
        for kind in self.kinds:
            for row in own.join(self._summed(kind), "batch_id", "left_anti").collect():
                missing.setdefault(row["batch_id"], []).append(kind)
        return dict(sorted(missing.items()))

    def pending(self) -> list[int]:
        """Batches that added or deleted facts and are not summed yet: as many as came since the last refresh."""
        return list(self._missing())

    def refresh(self) -> list[int]:
        """Sum up the batches that are not summed yet, and tell which. A batch that stops before its commit is summed again."""
        missing = self._missing()
        for batch_id, kinds in missing.items():
            self._sum_batch(batch_id, kinds)
        return list(missing)

    def added(self, batch_id: int) -> DataFrame:
        """The facts a batch wrote, read from its folder alone."""
        w = self.warehouse
        schema = [f for f in w.schema("fact_orders").fields if f.name not in ("_batch_id", w.fact_folder)]
        return w.spark.read.schema(", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)).parquet(f"{w.path('fact_orders')}/_batch_id={batch_id}")

    def removed(self, batch_id: int) -> DataFrame | None:
        """The facts a batch deleted, read from the files it marked."""
        w = self.warehouse
        marks = w._scan("fact_vectors").where(F.col("_batch_id") == batch_id)
        files = [r["file"] for r in marks.select("file").distinct().collect()]  # names of files, not of rows
        if not files:
            return None
        # Names are as ``_placed_facts`` makes them: batch/folder/file, or compacted/generation/file.
        def path(name: str) -> str:
            a, b, file = name.split("/")
            if a == "compacted":
                return f"{w.path('fact_compacted')}/_generation={b}/{file}"
            return f"{w.path('fact_orders')}/_batch_id={a}/{w.fact_folder}={b}/{file}"

        def name_of(part: DataFrame, compacted: bool) -> DataFrame:
            folder = F.regexp_extract("_metadata.file_path", r"_generation=([0-9]+)/" if compacted else rf"_batch_id=([0-9]+)/{w.fact_folder}=([^/]+)/", 1)
            second = F.regexp_extract("_metadata.file_path", rf"_batch_id=([0-9]+)/{w.fact_folder}=([^/]+)/", 2)
            parts = [F.lit("compacted"), folder] if compacted else [folder, second]
            row = F.col("_metadata.row_index")
            return part.select(
                *columns, F.concat_ws("/", *parts, "_metadata.file_name").alias("file"),
                F.shiftright(row, BITMAP_BITS).alias("bucket"), row.bitwiseAND(F.lit((1 << BITMAP_BITS) - 1)).alias("position"),
            )

        fields = star_schema("fact_orders", w.id_type).fields
        columns = [f.name for f in fields]
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
        rows = None
        for compacted in (False, True):
            paths = [path(f) for f in files if f.startswith("compacted/") == compacted]
            if paths:
                own = name_of(w.spark.read.schema(schema).parquet(*paths), compacted)
                rows = own if rows is None else rows.unionAll(own)
        bitmaps = marks.select("file", "bucket", "bitmap")
        if w.bitmaps(batch_id) <= BROADCAST_BITMAPS:
            bitmaps = F.broadcast(bitmaps)
        marked = rows.join(bitmaps, ["file", "bucket"])
        return marked.where(
            "shiftright(cast(conv(hex(substring(bitmap, cast(shiftright(position, 3) AS INT) + 1, 1)), 16, 10) AS INT), cast(position & 7 AS INT)) & 1 = 1"
        ).select(*columns)

    def _sum_batch(self, batch_id: int, kinds: Collection[str]) -> None:
        w = self.warehouse
        told = {r["table_name"]: r for r in w.commits().where(F.col("batch_id") == batch_id).select("table_name", "committed_at", "rows").collect()}
        parts = [(1, self.added(batch_id))] if "fact_orders" in told else []
        if "fact_vectors" in told and (gone := self.removed(batch_id)) is not None:
            parts.append((-1, gone))

        def write(kind: str) -> int:
            sums = None
            for sign, rows in parts:
                own = rows.withColumn("quarter_sk", F.expr(QUARTER)).groupBy(*KEYS[kind]).agg(*[(F.expr(e) * sign).cast("bigint" if c == "n" else "decimal(38,2)").alias(c) for c, e in _SUMS.items()])
                sums = own if sums is None else sums.unionAll(own)
            sums.write.mode("overwrite").parquet(f"{self._path(kind)}/_batch_id={batch_id}")
            return 1

        w._together([partial(write, kind) for kind in kinds])
        at = next(iter(told.values()))["committed_at"]
        for kind in kinds:
            w._commit({f"report_sums_{kind}": len(parts)}, batch_id, F.lit(at))

    def sums(self, kind: str, version: int | None = None) -> DataFrame:
        """Sums of all facts left at a version, by the keys of the kind: n, amount, listed."""
        w = self.warehouse
        kinds = star_schema("fact_orders", w.id_type)
        keys = [f"{k} {'int' if k == 'quarter_sk' else kinds[k].dataType.simpleString()}" for k in KEYS[kind]]
        rows = w.spark.read.schema(", ".join([*keys, _SCHEMA])).parquet(self._path(kind))
        done = self._summed(kind)
        if version is not None:
            rows, done = rows.where(F.col("_batch_id") <= version), done.where(F.col("batch_id") <= version)
        rows = rows.join(done.select(F.col("batch_id").alias("_batch_id")), "_batch_id", "left_semi")
        if kind == "quarters":
            # Products come next, and a product has few quarters: one shuffle serves the sums and the join.
            rows = rows.repartition(F.col("product_key"))
        added = rows.groupBy(*KEYS[kind]).agg(F.sum("n").alias("n"), *[F.sum(c).cast("decimal(38,2)").alias(c) for c in ("amount", "listed")])
        return added.where("n <> 0")

    # ---- the reports ----------------------------------------------------

    def daily_sales(self, version: int | None = None) -> DataFrame:
        return analytics.daily_sales(self.sums("days", version), self.warehouse.star(version))

    def quarter_category(self, version: int | None = None) -> DataFrame:
        own = self.sums("quarters", version).withColumn("year", F.expr("quarter_sk div 10").cast("int")).withColumn("quarter", F.col("quarter_sk") % 10)
        return analytics.quarter_category(own, self.warehouse.star(version))

    def category_totals(self, version: int | None = None) -> DataFrame:
        own = self.sums("pairs", version).select("customer_key", "product_key", F.col("listed").alias("amount"))
        return analytics.category_totals(own, self.warehouse.star(version))

    def top_customers(self, version: int | None = None, n: int = 10) -> DataFrame:
        own = self.sums("pairs", version).groupBy("customer_key").agg(F.sum("n").alias("n"), F.sum("amount").alias("amount"))
        return analytics.top_customers(own, self.warehouse.star(version), n)
