"""Time the headline jobs on the test tables; prints one JSON line.

Reads ``BENCH_SF_DIR`` and ``BENCH_CPUS``.  ``queries`` also has the plain
variants of operators (``…_plain``) for comparison; ``value`` leaves them out.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from datetime import date
from pathlib import Path

from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

from tagledger.operators import dims, fact
from tagledger.operators.checks import STAR_CHECKS, run_checks
from tagledger.operators.conform import cast_types, fill_and_key, valid_rows
from tagledger.operators.dedupe import keep_one
from tagledger.operators.ordering import global_row_number
from tagledger.operators.trend import previous_value
from tagledger.plans.silver import CARRIED, KEYS, build_silver
from tagledger.plans.star import build_dims
from tagledger.schemas import Slot
from tagledger.session import pin_session, scratch_root, scratch_scope, stage
from tagledger.sinks.silver import replace_slot
from tagledger.sources.pages import card_records, extract_cards
from tagledger.sources.silver import staging
from tagledger.suite.views import SHOP_RULES, lineitem_bronze, listing_pages

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "4")
SLOT = Slot.parse("2024-01-01", "06")


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tagledger-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    pin_session(spark)
    times: dict[str, float] = {}

    def timed(name: str, job) -> None:
        job()  # warm-up: class loading and code generation are not the operator's cost
        start = time.perf_counter()
        job()
        times[name] = round(time.perf_counter() - start, 3)

    with scratch_scope(spark):
        bronze = stage(lineitem_bronze(spark, SF_DIR), "bronze")
        silver = stage(build_silver(bronze, SLOT), "silver")
        base = staging(silver)
        keyed = stage(fill_and_key(valid_rows(cast_types(bronze))).select(*KEYS, *CARRIED), "keyed")
        star = fact.Dims(
            stage(dims.dim_category(base), "c"),
            stage(dims.dim_platform(base), "p"),
            stage(dims.dim_date(spark, date(1995, 1, 1), 2600), "d"),
            stage(dims.dim_product(base), "t"),
        )
        built = stage(fact.build_fact(base, star), "fact")
        tables = {
            "staging": base,
            "dim_category": star.category,
            "dim_platform": star.platform,
            "dim_date": star.date,
            "dim_product": star.product,
            "fact_price_snapshots": built,
        }
        joined = stage(fact.star_join(base, star), "joined")
        order = fact.sequence_order()

        timed("build_silver", lambda: run(build_silver(bronze, SLOT)))
        timed("dedupe", lambda: run(keep_one(keyed, KEYS)))
        ranked = Window.partitionBy(*KEYS).orderBy(*CARRIED)
        timed("dedupe_window_plain", lambda: run(keyed.withColumn("r", F.row_number().over(ranked)).filter("r = 1")))
        root = f"{scratch_root(spark)}/bench-{uuid.uuid4().hex}"
        timed("replace_slot", lambda: replace_slot(silver, root, SLOT))

        def all_dims() -> None:
            built = build_dims(base)
            for df in (built.category, built.platform, built.product):
                run(df)

        timed("build_dims", all_dims)
        timed("snapshot_id", lambda: run(global_row_number(joined, order, "snapshot_id", spread_copies=False)))
        timed("snapshot_id_window_plain", lambda: run(joined.withColumn("n", F.row_number().over(Window.orderBy(*order)))))
        timed("price_trend", lambda: run(fact.add_trend(joined)))
        lag = [joined, "product_key", fact.history_order(), "current_price", "previous_price"]
        timed("price_trend_hot", lambda: run(previous_value(*lag, hot_rows=100)))
        timed("build_fact", lambda: run(fact.build_fact(base, star)))
        timed("run_checks", lambda: run(run_checks(tables, STAR_CHECKS)))
        keep = ["category", "page_num", "scraped_at"]
        pages = stage(listing_pages(spark, SF_DIR).repartition(int(CPUS)), "pages")
        if card_records(extract_cards(pages, SHOP_RULES, keep=keep), keep=keep).isEmpty():
            raise RuntimeError("the pages give no records")
        timed("page_cards", lambda: run(card_records(extract_cards(pages, SHOP_RULES, keep=keep), keep=keep)))

    headline = sum(t for n, t in times.items() if not n.endswith("_plain"))
    print(
        json.dumps(
            {
                "metric": "headline_jobs_total",
                "value": round(headline, 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
