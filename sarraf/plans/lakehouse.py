"""A lakehouse kept on storage and refreshed run by run, each layer from what is new in the layer below.

landing -> bronze (new files appended) -> silver (new bronze rows merged by
key, bad rows set aside) -> dimensions (rebuilt), facts (new silver loads
merged by key), marts (days the load touched, or rebuilt) -> histories of
customers and cards.
"""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from sarraf.operators import health
from sarraf.operators.history import keep, read_kept
from sarraf.operators.merge import _among, high_watermark, merge, without_late
from sarraf.plans import history, silver
from sarraf.plans.warehouse import FACTS, MODELS, Warehouse, fraud_labels
from sarraf.schemas import BATCH_COLUMNS, EVENT_TIME, LANDED_COLUMNS, RAW_SCHEMAS
from sarraf.settings import RunContext
from sarraf.sources import tables
from sarraf.streaming import bronze
from sarraf.streaming.silver import LOAD, keep_silver, last_load, load_rows

# silver table: (entity, landed table)
SILVER = {
    "silver_atm_master": ("atm_master", "raw_atm_master"),
    "silver_customers": ("customers", "raw_customers"),
    "silver_cards": ("cards", "raw_cards"),
    "silver_card_transactions": ("card_transactions", "raw_card_transactions"),
    "silver_wallet": ("wallet_transactions", "raw_wallet_transactions"),
    "silver_out_of_cash": ("out_of_cash", "raw_out_of_cash"),
    "silver_kaggle": ("kaggle_transactions", "raw_kaggle_transactions"),
}
LABELS = "raw_fraud_labels"
# fact: (silver table it loads from, key it is merged on)
FACT_LOADS = {
    "fact_atm_transactions": ("silver_card_transactions", "atm_transaction_key"),
    "fact_card_transactions": ("silver_kaggle", "card_transaction_key"),
    "fact_wallet_transactions": ("silver_wallet", "wallet_transaction_key"),
    "fact_out_of_cash_events": ("silver_out_of_cash", "out_of_cash_key"),
}
# mart with rows per day: (its date, the facts it is made from)
DAILY_MARTS = {
    "atm_performance": (
        "transaction_date", ("fact_atm_transactions", "fact_out_of_cash_events", "fact_wallet_transactions")
    ),
    "replenishment_analysis": ("activity_date", ("fact_atm_transactions", "fact_out_of_cash_events")),
    "channel_comparison": (
        "transaction_date", ("fact_atm_transactions", "fact_wallet_transactions", "fact_card_transactions")
    ),
}
DIMENSIONS = [m for m in MODELS if m.startswith("dim_") and MODELS[m].stored]
MARTS = [m for m in MODELS if not m.startswith(("silver_", "stg_", "dim_", "fact_", "pan_"))]
DATE = "transaction_date"


class Lakehouse:
    def __init__(self, spark: SparkSession, root: str, ctx: RunContext, files_per_batch: int | None = None):
        self.spark, self.root, self.ctx, self.files_per_batch = spark, root.rstrip("/"), ctx, files_per_batch

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def read(self, layer: str, table: str) -> DataFrame:
        if layer == "snapshots":
            return read_kept(self.spark, self.path(layer, table))
        frame = tables.read(self.spark, self.path(layer, table))
        day = DAILY_MARTS[table][0] if table in DAILY_MARTS else DATE if table in FACT_LOADS else None
        # Partition values of a table that has NULL only are not known to be dates.
        return frame.withColumn(day, F.col(day).cast("date")) if day else frame

    def has(self, layer: str, table: str) -> bool:
        return tables.exists(self.spark, self.path(layer, table))

    def bronze(self, raw: str) -> DataFrame:
        """A bronze table; one that has never landed has no rows."""
        schema = f"{RAW_SCHEMAS[raw]}, {BATCH_COLUMNS}"
        return self.read("bronze", raw) if self.has("bronze", raw) else self.spark.createDataFrame([], schema)

    def _warehouse(self, computed_keys: bool = False) -> Warehouse:
        """Plans over what is stored now; a stored table is opened when a plan uses it."""
        names = [raw for _, raw in SILVER.values()] + [LABELS]

        def stored(name: str) -> DataFrame | None:
            layer = "silver" if name in SILVER or name == "pan_customer_map_silver" else "marts"
            return self.read(layer, name) if MODELS[name].stored and self.has(layer, name) else None

        return Warehouse(self.spark, {n: partial(self.bronze, n) for n in names}, self.ctx, existing=stored)

    # --- bronze ---------------------------------------------------------------------

    def ingest(self, landing_root: str) -> dict[str, int]:
        """Append what has landed since the last run to bronze; new rows per table, 0 without a folder or files."""
        return {
            name: bronze.ingest_new(
                self.spark, f"{landing_root}/{name}", self.path("bronze", name), self.path("checkpoints/bronze", name),
                StructType.fromDDL(f"{schema}, {LANDED_COLUMNS}"), self.ctx, EVENT_TIME.get(name), self.files_per_batch,
            )
            for name, schema in RAW_SCHEMAS.items()
        }

    # --- silver ---------------------------------------------------------------------

    def _related(self, entity: str) -> dict[str, DataFrame]:
        """Tables that enrich an entity, where they exist."""
        if entity == "card_transactions" and self.has("silver", "silver_customers"):
            return {"customers": self.read("silver", "silver_customers")}
        if entity == "kaggle_transactions" and self.has("bronze", LABELS):
            return {"labels": fraud_labels(self._warehouse())}
        return {}

    def _customer_ids(self) -> tuple | None:
        """Count and checksum of the known clients."""
        if not self.has("silver", "silver_customers"):
            return None
        ids = self.read("silver", "silver_customers").select(F.xxhash64("client_id").cast("decimal(38,0)").alias("h"))
        return tuple(ids.agg(F.count("*"), F.sum("h")).first())

    def refresh_silver(self, batch: str) -> dict[str, int]:
        """Merge new bronze rows into silver and set bad rows aside under ``batch``; rows merged per table.

        Rows that are stored already change with what they were enriched from:
        new clients renumber the clients of PANs, so card transactions are then merged
        from the whole of bronze; new fraud labels are put on stored purchases.
        """
        merged, clients = {}, self._customer_ids()
        had = {name: self.has("silver", name) for name in SILVER}
        for name, (entity_name, raw) in SILVER.items():
            merged[name] = 0
            if self.has("bronze", raw):
                merged[name] = keep_silver(
                    bronze.open_bronze(self.spark, self.path("bronze", raw), self.files_per_batch),
                    silver.ENTITIES[entity_name], self.path("silver", name), f"{self.root}/quarantine",
                    self.path("checkpoints/silver", name), self.ctx, partial(self._related, entity_name), batch,
                )
        if had["silver_card_transactions"] and self._customer_ids() != clients:
            merged["silver_card_transactions"] = load_rows(
                self.path("silver", "silver_card_transactions"), self._warehouse().plan("silver_card_transactions"),
                silver.CARD_TRANSACTIONS,
            )
        merged["silver_kaggle"] += self._flag_stored(had["silver_kaggle"])
        if self.has("bronze", "raw_card_transactions") and self.has("silver", "silver_customers"):
            if merged["silver_card_transactions"] or not self.has("silver", "pan_customer_map_silver"):
                plan = self._warehouse().plan("pan_customer_map_silver")
                merged["pan_customer_map_silver"] = tables.write(plan, self.path("silver", "pan_customer_map_silver"))
        return merged

    def _flag_stored(self, had_purchases: bool) -> int:
        """Put labels that came after their purchases on the stored rows; purchases merged."""
        path = self.path("silver", "silver_kaggle")
        if not self.has("bronze", LABELS) or not self.has("silver", "silver_kaggle"):
            return 0
        landed = self.read("bronze", LABELS)
        newest = high_watermark(landed, bronze.LOAD)
        seen, rows = int(tables.note(self.spark, path, "labels") or -1), 0
        if had_purchases and newest > seen:
            new = landed.filter(F.col(bronze.LOAD) > seen).select("transaction_id").distinct()
            purchases = self.read("silver", "silver_kaggle")
            late = purchases.join(new, "transaction_id", "left_semi")
            flagged = silver.enriched(silver.KAGGLE_TRANSACTIONS, late.drop("is_fraud", LOAD), **self._related("kaggle_transactions"))
            rows = load_rows(path, flagged, silver.KAGGLE_TRANSACTIONS)
        tables.put_note(self.spark, path, "labels", str(newest))
        return rows

    # --- dimensions, facts, marts ---------------------------------------------------

    def refresh_marts(self, full: bool = False, strict: bool = False, lateness_days: int = 0) -> dict[str, int]:
        """Rebuild dimensions, load facts from new silver loads, renew marts; rows written per table.

        Facts take the rows that were delivered since their last load, whatever
        their date.  ``strict`` takes only dates after the newest of the fact
        (less ``lateness_days``) instead.  Either way late rows are counted while
        they pass and the counts kept (``late_rows``).  ``full`` loads all rows.

        A mart by day is written for the days whose fact rows changed, unless a
        dimension did; the other marts are rebuilt when anything changed.
        """
        written, moved = {}, False
        for name in DIMENSIONS:
            path = self.path("marts", name)
            before = tables.note(self.spark, path, "content") if self.has("marts", name) else None
            written[name] = tables.write(self._warehouse().plan(name), path)
            now = self._content(name)
            tables.put_note(self.spark, path, "content", now)
            moved |= now != before
        touched = {}
        for name in FACT_LOADS:
            written[name], touched[name] = self._load_fact(name, full, strict, lateness_days)
        anything = full or moved or any(p is None or p for p in touched.values())
        for name in MARTS:
            path = self.path("marts", name)
            if name in DAILY_MARTS:
                days = [touched[f] for f in DAILY_MARTS[name][1] if f in touched]
                whole = full or moved or not self.has("marts", name) or any(d is None for d in days)
                written[name] = self._renew(name, None if whole else sorted({v for d in days for v in d}, key=str))
            else:
                rebuild = anything or not self.has("marts", name)
                written[name] = tables.write(self._warehouse().plan(name), path) if rebuild else 0
        return written

    def _content(self, dimension: str) -> str:
        """Count and checksum of a dimension without its load times."""
        frame = self.read("marts", dimension)
        columns = sorted(c for c in frame.columns if not c.startswith("_"))
        return str(tuple(frame.agg(F.count("*"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))).first()))

    def _load_fact(self, name: str, full: bool, strict: bool, lateness_days: int) -> tuple[int, list | None]:
        """(rows loaded, days touched) of one fact."""
        source, key = FACT_LOADS[name]
        path = self.path("marts", name)
        if not self.has("silver", source):
            return 0, []
        there = self.has("marts", name)
        seen = int(tables.note(self.spark, path, "load") or 0) if there and not full else 0
        newest = last_load(self.spark, self.path("silver", source))
        if newest <= seen:
            return 0, []
        wh = self._warehouse(computed_keys=True)
        rows = self.read("silver", source).filter(F.col(LOAD) > seen).drop(LOAD)
        watermark = high_watermark(self.read("marts", name), DATE) if there and not full else None
        oldest = watermark - dt.timedelta(days=lateness_days) if watermark and strict else watermark
        counted = Observation()
        kept = without_late(rows, DATE, oldest, counted, drop=strict)
        wh.use(source, kept)
        merged = merge(self.spark, path, FACTS[name](wh), key, DATE)
        if self.has("marts", name):
            tables.put_note(self.spark, path, "load", str(newest))
        got = tables.observed(counted, delivered=0, late=0, undated=0)
        line = {**got, "skipped": got["late"] if strict else 0, "watermark": watermark, "fact": name, "load": newest}
        tables.write(self.spark.createDataFrame([line], _LATE), f"{self.root}/late_rows", ["fact", "load"], only_touched=True)
        return merged.rows, merged.partitions

    def late_rows(self) -> DataFrame:
        """Delivered, late, undated and skipped rows of each load of each fact."""
        return tables.read_or_empty(self.spark, f"{self.root}/late_rows", StructType.fromDDL(_LATE))

    def _renew(self, name: str, days: list | None) -> int:
        """Write a mart by day, whole or for some days; rows written.

        Rows without a day stand for facts without one and for terminals that
        have no fact rows at all; they are renewed with any day.
        """
        date, facts = DAILY_MARTS[name]
        path = self.path("marts", name)
        if days is None:
            return tables.write(self._warehouse().plan(name), path, date)
        if not days:
            return 0
        wh = self._warehouse()
        wanted = sorted({*days, None}, key=str)
        for fact in facts:
            if fact in FACT_LOADS and self.has("marts", fact):
                wh.use(fact, wh.table(fact).filter(_among(DATE, wanted)))
        scratch = tables.scratch_dir(self.spark, "mart")
        fresh, _ = tables.stage(wh.plan(name), scratch)
        dated = fresh.filter(F.col(date).isNotNull())
        rows = tables.write(dated, path, date, only_touched=True)
        gone = {d for d in days if d is not None} - {r[0] for r in dated.select(date).distinct().collect()}
        for day in gone:
            tables.remove(self.spark, f"{path}/{date}={day}")
        undated = fresh.filter(F.col(date).isNull())
        if "atm_key" in fresh.columns:
            busy = self.read("marts", name).filter(F.col(date).isNotNull()).select("atm_key").distinct()
            idle = undated.filter(F.col("card_transactions") == 0).join(busy, "atm_key", "left_anti")
            undated = undated.filter(F.col("card_transactions") > 0).unionByName(idle)
        kept, n = tables.stage(undated, f"{scratch}-undated")
        if n:
            rows += tables.write(kept, path, date, only_touched=True)
        else:  # an empty file keeps the columns known
            kept.drop(date).write.mode("overwrite").parquet(f"{path}/{date}=__HIVE_DEFAULT_PARTITION__")
        tables.remove(self.spark, scratch)
        tables.remove(self.spark, f"{scratch}-undated")
        return rows

    # --- history, views, health -----------------------------------------------------

    def keep_history(self) -> dict[str, tuple[int, int]]:
        """Add the current customers and cards to their histories; rows closed and open per history."""
        wh, run_ts = self._warehouse(), self.ctx.now()
        run = self.ctx.run_ts.strftime("%Y%m%dT%H%M%S%f")
        return {
            name: keep(self.spark, self.path("snapshots", name), run, partial(self._versions, snapshot, wh.table(stg), run_ts))
            for name, stg, snapshot in (
                ("customers_snapshot", "stg_customers", history.customers_snapshot),
                ("cards_snapshot", "stg_cards", history.cards_snapshot),
            )
        }

    @staticmethod
    def _versions(snapshot, staged: DataFrame, run_ts, before: DataFrame | None) -> DataFrame:
        return snapshot(before, staged, run_ts)

    def register_views(self) -> None:
        """Silver tables and marts under their names for SQL."""
        stored = [("silver", n) for n in (*SILVER, "pan_customer_map_silver")]
        stored += [("marts", n) for n in (*DIMENSIONS, *FACTS, *MARTS)]
        tables.register_views({n: self.read(layer, n) for layer, n in stored if self.has(layer, n)})

    def quarantined(self, entity: str) -> DataFrame:
        """Bad rows of an entity of all batches; there may be none, so the columns are given."""
        raw = next(raw for name, raw in SILVER.values() if name == entity)
        kind = silver.ENTITIES[entity]
        plan = silver.enriched(kind, silver.quarantine(kind, self.bronze(raw), self.ctx))
        return tables.read_or_empty(
            self.spark, f"{self.root}/quarantine/{entity}", plan.withColumn("_batch", F.lit("")).schema
        )

    def health(self) -> DataFrame:
        """Rows, columns and latest load of every stored table, quarantine included."""
        layers = {
            "bronze": [raw for _, raw in SILVER.values()],
            "silver": [*SILVER, "pan_customer_map_silver"],
            "marts": [*DIMENSIONS, *FACTS, *MARTS],
        }
        stored = {
            layer: {n: self.read(layer, n) for n in names if self.has(layer, n)} for layer, names in layers.items()
        }
        stored["quarantine"] = {
            entity: self.quarantined(entity) for entity, raw in SILVER.values() if self.has("bronze", raw)
        }
        return health.layer_health(stored)


_LATE = "delivered long, late long, undated long, skipped long, watermark date, fact string, load long"
