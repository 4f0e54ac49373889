"""The loads, from feeds to star schema, over published table versions."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators import history, merge
from ..operators.keys import assign_keys
from ..operators.rows import check_unique, join_side
from ..sources.catalog import ensure_layers
from ..sources.feeds import REJECT, read_feed
from ..sources.names import FILES, TableName
from ..sources.scratch import materialize
from ..sources.snapshots import COMPRESSION, SnapshotTable
from . import gold, report_views, reports, silver
from .analytics import VIP_MONTHS, VIP_SALES
from .runlog import Outcome, RunLog, utc_now

CURRENT, PAST = "current", "past"
ACCEPTED, REJECTED = "accepted", "rejected"
BUSINESS_KEYS = {"dim_customers": "customer_id", "dim_products": "product_id"}
#: Key buckets of the fact (in each year) and of the open versions of a dimension.
BUCKETS = 8


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.lpad(F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("string"), len(str(buckets - 1)), "0")


class Warehouse:
    """Tables of the three layers below one folder.

    `clock` gives the load time; its date is the day a version starts. `fact_keys`
    are the columns that name a row of the fact: order number, product and number of
    the line among them. The fact lies in parts by year and key bucket, open dimension
    versions in parts by key bucket; a load rewrites the buckets of changed rows only,
    so their numbers set what one changed row costs: take as many as keep a part at a
    few files.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        clock: Callable[[], dt.datetime] = utc_now,
        fact_keys: list[str] | None = None,
        fact_buckets: int = BUCKETS,
        dim_buckets: int = BUCKETS,
    ):
        self.spark, self.clock = spark, clock
        self.fact_keys = fact_keys or [*gold.FACT_KEYS, gold.LINE]
        self.fact_bucket = bucket_of(self.fact_keys, fact_buckets)
        # scratch tables of this object; two writers never share them
        self.slot = f"tallyhouse-{uuid.uuid4().hex}"
        self.log = RunLog(spark, f"{root.rstrip('/')}/gold/dw_load_log", clock)
        accepted = F.when(F.col(REJECT).isNull(), ACCEPTED).otherwise(REJECTED)
        self.open_part = {
            name: F.concat(F.lit(f"{CURRENT}."), bucket_of([key], dim_buckets))
            for name, key in BUSINESS_KEYS.items()
        }
        parts = {
            name: F.when(F.col("scd_is_current"), part).otherwise(PAST) for name, part in self.open_part.items()
        }
        parts["fact_sales"] = F.concat_ws(".", F.year("date_key"), self.fact_bucket)
        orders = {"fact_sales": self.fact_keys}
        self.tables: dict[tuple[str, str], SnapshotTable] = {}
        for layer, layout in schemas.LAYERS.items():
            for name, schema in layout.items():
                if name == "dw_load_log":
                    continue
                folder = f"{root.rstrip('/')}/{layer}/{name}"
                if layer == "bronze":
                    raw = T.StructType(schema.fields + [T.StructField(REJECT, T.StringType())])
                    table = SnapshotTable(spark, folder, raw, accepted)
                else:
                    part = parts.get(name)
                    table = SnapshotTable(spark, folder, schema, part, part is not None, orders.get(name))
                self.tables[layer, name] = table

    def table(self, layer: str, name: str) -> SnapshotTable:
        return self.tables[layer, name]

    def load(self, layer: str, name: str, parts: list[str] | None = None) -> DataFrame:
        """A table, or only some parts of it, such as years of the fact."""
        table = self.table(layer, name)
        if layer == "bronze":
            return table.read([ACCEPTED]).drop(REJECT)
        return table.read(parts)

    def rejects(self, name: str) -> DataFrame:
        """Rows of the last feed that could not be read as declared."""
        return self.table("bronze", name).read([REJECTED])

    # -- names ------------------------------------------------------------

    def register(self) -> None:
        """Views `<layer>.<table>` that follow the loads of this object from now on.

        Bronze names show accepted rows. To be called once by each process that loads;
        it brings names up to date that loads without it have left behind.
        """
        ensure_layers(self.spark)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {FILES}")
        for (layer, name), table in self.tables.items():
            raw = layer == "bronze"
            columns = [c for c in table.schema.names if not (raw and c == REJECT)]
            entry = TableName(self.spark, table, layer, name, columns, ACCEPTED if raw else None)
            entry.create()
            table.on_publish = entry.follow
        self.log.register("gold.dw_load_log")

    def register_reports(
        self,
        as_of: dt.date | None = None,
        vip_months: int = VIP_MONTHS,
        vip_sales: float = VIP_SALES,
        high_sales: float = reports.HIGH_SALES,
        mid_sales: float = reports.MID_SALES,
    ) -> None:
        """Views `gold.report_customers` and `gold.report_products` over the tables by name.

        They are computed when read, for `as_of` or for the day of reading, and need `register`.
        """
        selects = {
            "report_customers": report_views.customers_sql(as_of, vip_months, vip_sales),
            "report_products": report_views.products_sql(as_of, high_sales, mid_sales),
        }
        for name, select in selects.items():
            self.spark.sql(f"CREATE OR REPLACE VIEW gold.{name} AS {select}")

    def vacuum(self, keep_versions: int = 1) -> int:
        """Delete what the newest versions of all tables no longer list; batches deleted."""
        return sum(table.vacuum(keep_versions) for table in self.tables.values())

    def compact(self, most_batches: int = 16) -> dict[str, list[str]]:
        """Merge parts that lie in many batches; table to parts rewritten."""
        return {name: parts for (_, name), t in self.tables.items() if (parts := t.compact(most_batches))}

    # -- bronze -----------------------------------------------------------

    def load_bronze(
        self, feeds: dict[str, str], max_rejects: int | None = None, max_reject_share: float | None = None
    ) -> None:
        """Full refresh of the raw tables from `feeds`, table name to path.

        Unreadable rows are set aside, counted and logged. With a limit, a feed that
        has more of them, in rows or as a share of its rows, fails instead.
        """
        self.log.run(
            {
                f"bronze.{name}": lambda n=name, p=path: self._load_feed(n, p, max_rejects, max_reject_share)
                for name, path in feeds.items()
            }
        )

    def _load_feed(
        self, name: str, path: str, max_rejects: int | None, max_share: float | None
    ) -> Outcome:
        def check(written: dict[str, int]) -> None:
            count, rows = written.get(REJECTED, 0), sum(written.values())
            if max_rejects is not None and count > max_rejects:
                raise ValueError(f"{name}: {count} unreadable rows, {max_rejects} allowed")
            if max_share is not None and count > max_share * rows:
                raise ValueError(f"{name}: {count} of {rows} rows unreadable, a share of {max_share} allowed")

        feed = read_feed(self.spark, path, schemas.BRONZE[name])
        written = self.table("bronze", name).replace(feed, check)  # parsed once
        rejected = written.get(REJECTED, 0)
        note = f"Rows rejected: {rejected}" if rejected else None
        return Outcome(inserted=written.get(ACCEPTED, 0), message=note)

    # -- silver -----------------------------------------------------------

    def load_silver(self, only: list[str] | None = None) -> None:
        """Full refresh of the cleaned tables, or of some."""
        now = self.clock()
        self.log.run(
            {
                f"silver.{name}": lambda n=name, c=clean: self._refresh(n, c, now)
                for name, clean in self._cleaning(now.date()).items()
                if only is None or name in only
            }
        )

    def _cleaning(self, as_of: dt.date) -> dict[str, Callable[[DataFrame], DataFrame]]:
        return {
            "crm_cust_info": silver.clean_crm_cust_info,
            "crm_prd_info": silver.clean_crm_prd_info,
            "crm_sales_details": silver.clean_crm_sales_details,
            "erp_cust_az12": lambda raw: silver.clean_erp_cust_az12(raw, as_of),
            "erp_loc_a101": silver.clean_erp_loc_a101,
            "erp_px_cat_g1v2": silver.clean_erp_px_cat_g1v2,
        }

    def _refresh(self, name: str, clean, now: dt.datetime) -> Outcome:
        """Clean one table; what the sales log counts is seen by the write itself."""
        raw, seen = self.load("bronze", name), None
        if name == "crm_sales_details" and ACCEPTED in self.table("bronze", name).parts():
            seen = Observation()
            raw = raw.observe(seen, *silver.sales_faults())
        written = self.table("silver", name).replace(silver.with_audit(clean(raw), name, now))
        found = seen.get if seen else {}
        labels = {"bad_dates": "Dates set to NULL", "large_amounts": "Amounts set to NULL"}
        notes = [f"{label}: {found[k]}" for k, label in labels.items() if found.get(k)]
        return Outcome(inserted=sum(written.values()), message="; ".join(notes) or None)

    # -- gold -------------------------------------------------------------

    def load_dim_date(
        self, start: dt.date = gold.CALENDAR_START, end: dt.date = gold.CALENDAR_END
    ) -> None:
        calendar = gold.build_dim_date(self.spark, start, end)
        self.log.run(
            {"gold.load_dim_date": lambda: Outcome(inserted=self._add_days(calendar))}
        )

    def _add_days(self, calendar: DataFrame) -> int:
        table = self.table("gold", "dim_date")
        return sum(table.append(merge.missing_rows(table.read(), calendar, ["date_key"])).values())

    def load_dimensions(self, only: list[str] | None = None) -> None:
        """Customers and products, or one of them; products missing from the source are expired."""
        now = self.clock()
        steps = {
            "dim_customers": lambda: self._load_customers(now),
            "dim_products": lambda: self._load_products(now),
        }
        self.log.run({f"gold.load_{n}": step for n, step in steps.items() if only is None or n in only})

    def _load_customers(self, now: dt.datetime) -> Outcome:
        stage = gold.stage_customers(
            self.load("silver", "crm_cust_info"),
            join_side(self.load("silver", "erp_cust_az12").select("cid", "bdate", "gen")),
            join_side(self.load("silver", "erp_loc_a101").select("cid", "cntry")),
        )
        return self._apply_history("dim_customers", stage, gold.CUSTOMER_TRACKED, "customer_key", False, now)

    def _load_products(self, now: dt.datetime) -> Outcome:
        stage = gold.stage_products(
            self.load("silver", "crm_prd_info"), self.load("silver", "erp_px_cat_g1v2")
        )
        return self._apply_history("dim_products", stage, gold.PRODUCT_TRACKED, "product_key", True, now)

    def _apply_history(self, name, stage, tracked, key, expire_missing, now) -> Outcome:
        """Join once, write only what moved.

        Past versions are appended to. Of the open ones, the buckets that an expired
        version leaves are rewritten; new versions add files to theirs.
        """
        table, business_key = self.table("gold", name), BUSINESS_KEYS[name]
        changes = history.scd2_changes(
            table.read([CURRENT]), stage, business_key, tracked, key, now.date(), now, expire_missing
        )
        moved = materialize(
            changes.filter(F.col(history.ACTION) != history.KEEP), f"{self.slot}/{name}-moved", COMPRESSION
        )
        counts = history.action_counts(moved)
        if not counts:
            return Outcome()
        last_key = table.read().agg(F.max(key)).first()[0] or 0
        expired = moved.filter(F.col(history.ACTION) == history.EXPIRE)
        added = assign_keys(
            moved.filter(F.col(history.ACTION) == history.INSERT), key, [business_key], last_key
        )
        left = expired.select(self.open_part[name].alias("part")).distinct()
        touched = [r.part for r in left.collect()]  # buckets
        ended = join_side(expired.select(key), counts.get(history.EXPIRE, 0))
        kept = table.read(touched).join(ended, key, "left_anti")
        columns = table.schema.names
        rows = kept.select(*columns).unionByName(expired.select(*columns)).unionByName(
            added.select(*columns)
        )
        table.rewrite(rows, touched)
        return Outcome(
            inserted=counts.get(history.INSERT, 0), expired=counts.get(history.EXPIRE, 0)
        )

    def load_fact_sales(self) -> None:
        self.log.run({"gold.load_fact_sales": self._merge_sales})

    def _merge_sales(self) -> Outcome:
        now = self.clock()
        stage = materialize(
            gold.stage_sales(
                gold.number_lines(self.load("silver", "crm_sales_details")),
                self._open_keys("dim_products", "product_number", "product_key"),
                self._open_keys("dim_customers", "customer_id", "customer_key"),
            ),
            f"{self.slot}/sales-stage",
            COMPRESSION,
        )
        sales, _ = gold.split_orphans(stage)
        lost = F.count_if(gold.is_orphan()).alias("orphans")
        seen = stage.agg(lost, F.count("*").alias("rows")).first()
        skipped = seen["orphans"]
        message = f"Orphan rows skipped: {skipped}" if skipped else None
        dim_date = self.table("gold", "dim_date")
        dim_date.append(gold.missing_dates(dim_date.read(), sales))

        table = self.table("gold", "fact_sales")
        sales = sales.withColumn("dw_insert_date", F.lit(now))
        if not table.parts():
            # nothing to match: the staged rows are the new ones
            check_unique(sales, self.fact_keys, "merge source")
            inserted = seen["rows"] - skipped
            if inserted:
                table.append(sales.select(*table.schema.names))
            return Outcome(inserted=inserted, message=message)
        delta = materialize(
            merge.merge_delta(
                self._reachable(table, sales),
                sales,
                self.fact_keys,
                gold.FACT_COMPARE,
                gold.FACT_SET,
                {"_old_part": table.part},
            ),
            f"{self.slot}/sales-delta",
            COMPRESSION,
        )
        counts = history.action_counts(delta, merge.ACTION)
        if counts:
            # parts an updated row leaves are rewritten; new rows only add files
            updates = delta.filter(F.col(merge.ACTION) == merge.UPDATE)
            touched = [r[0] for r in updates.select("_old_part").distinct().collect()]  # years and buckets
            changed = join_side(updates.select(*self.fact_keys), counts.get(merge.UPDATE, 0))
            stay = table.read(touched).join(changed, self.fact_keys, "left_anti")
            table.rewrite(stay.unionByName(delta.select(*table.schema.names)), touched)
        return Outcome(
            inserted=counts.get(merge.INSERT, 0),
            updated=counts.get(merge.UPDATE, 0),
            message=message,
        )

    def _open_keys(self, name: str, business_key: str, key: str) -> DataFrame:
        """What staged sales take from the open versions of a dimension."""
        return join_side(self.table("gold", name).read([CURRENT]).select(business_key, key, "scd_is_current"))

    def _reachable(self, table: SnapshotTable, sales: DataFrame) -> DataFrame:
        """The rows of the fact that staged sales can match: their buckets and range of order numbers."""
        by = self.fact_keys[0]
        ends = sales.agg(
            F.collect_set(self.fact_bucket).alias("buckets"), F.min(by).alias("lo"), F.max(by).alias("hi")
        ).first()
        parts = [p for p in table.parts() if p.split(".")[-1] in ends.buckets]
        if not parts:
            return table.read(parts)
        rows = join_side(table.read(parts))
        return rows.where(F.col(by).between(ends.lo, ends.hi))

    def load_gold(
        self, start: dt.date = gold.CALENDAR_START, end: dt.date = gold.CALENDAR_END
    ) -> None:
        """Calendar from `start` to `end`, dimensions, then the fact that refers to them."""
        self.load_dim_date(start, end)
        self.load_dimensions()
        self.load_fact_sales()

    def load_all(
        self,
        feeds: dict[str, str],
        max_rejects: int | None = None,
        max_reject_share: float | None = None,
        start: dt.date = gold.CALENDAR_START,
        end: dt.date = gold.CALENDAR_END,
    ) -> None:
        self.load_bronze(feeds, max_rejects, max_reject_share)
        self.load_silver()
        self.load_gold(start, end)
