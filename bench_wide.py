"""Time raw table -> labelled text on a table of the full width and size.

Derives a raw voucher table of 54 columns and six rows per line item from the tables in
$BENCH_SF_DIR (3.6 million rows at sf0.1), writes it to a new temporary folder, and
times the whole preparation of it. Prints one JSON line; takes minutes and about half a
gigabyte of disk. ``bench.py`` runs the same with one row per line item.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from tabwright.catalog.lookups import HOLIDAYS  # noqa: E402
from tabwright.fixed_values import COLUMN_NAMES  # noqa: E402
from tabwright.operators.text import text_length_stats  # noqa: E402
from tabwright.plans.vouchers import (  # noqa: E402
    BaseTableConfig,
    TextConfig,
    base_and_classes,
    labelled_text,
)
from tabwright.session import build_session  # noqa: E402

FEATURES = [
    "date", "close_date", "company_name", "vat_id_company", "company_business_type",
    "company_business_item", "vat_message_code_company", "party_name", "party_type",
    "vat_id_party", "business_type", "business_item", "vat_message_code", "document_type",
    "is_multi", "is_electronic", "service_charge", "card_number", "supply_amount",
    "vat_amount", "total_amount", "item", "day_type", "journal_key",
]


def wide_vouchers(spark, folder, copies=6):
    def table(name):
        return spark.read.parquet(f"{folder}/{name}.parquet")

    joined = (
        table("lineitem")
        .join(table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table("part"), F.col("l_partkey") == F.col("p_partkey"))
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    )
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "copy")
    day = F.date_format("l_shipdate", "yyyyMMdd")
    known = {
        "id": key,
        "year": F.year("l_shipdate").cast("double"),
        "date": day.cast("double"),
        "close_date": F.when(F.col("l_returnflag") == "R", day),
        "vat_type": (F.col("p_size") % 20).cast("double"),
        "acct_code": F.concat("p_brand", "p_type"),
        "vat_id_party": F.col("c_custkey").cast("string"),
        "vat_id_company": F.col("l_suppkey").cast("string"),
        "supply_amount": F.col("l_extendedprice") + F.col("copy"),
        "vat_amount": (F.col("l_extendedprice") * F.col("l_tax")).cast("string"),
        "total_amount": F.col("l_extendedprice") * (1 + F.col("l_tax")),
        "vat_message_code": F.when(F.col("l_quantity") < 40, (F.col("p_size") % 7 + 1).cast("double")),
        "document_type": (10 + F.col("l_linenumber")).cast("double"),
        "party_type": (11 + F.col("l_linenumber")).cast("double"),
        "transaction_code": F.lit(2.0),
        "party_name": F.col("c_name"),
        "item": F.col("p_name"),
        "journal_key": key,
        "service_charge": F.lit(0.0),
        "quantity": F.col("l_quantity"),
    }
    fillers = [F.col("p_type"), F.col("c_mktsegment"), F.col("l_returnflag"), F.col("o_orderpriority")]
    columns = []
    for i, (raw, name) in enumerate(COLUMN_NAMES.items()):
        columns.append(known.get(name, fillers[i % len(fillers)]).alias(raw))
    return joined.select(*columns)


def wide_text(spark, folder, cpus, copies=6) -> dict:
    """Seconds from the written raw table to split folders of labelled text."""
    path = tempfile.mkdtemp(prefix="run-") + "/raw"
    wide_vouchers(spark, folder, copies).repartition(cpus * 2).write.parquet(path)

    start = time.perf_counter()
    raw = spark.read.parquet(path)
    base, classes = base_and_classes(
        raw,
        BaseTableConfig(
            features=FEATURES,
            dropna_columns=["vat_id_party", "date", "total_amount", "acct_code", "year"],
            drop=[{"column": "vat_type", "values": ["17", "18", "19"]}],
            exclude_columns=["id", "created_at", "batch_no", "name"],
            holidays=HOLIDAYS,
            min_label_count=3,
        ),
    )
    ready = time.perf_counter()
    text, _ = labelled_text(
        base,
        TextConfig(
            key="journal_key", text_columns=FEATURES, separator="^ ", key_value_separator=":"
        ),
        classes,
    )
    out = tempfile.mkdtemp(prefix="run-") + "/text"
    text.write.partitionBy("split").parquet(out)
    end = time.perf_counter()
    rows = {r["split"]: r["rows"] for r in text_length_stats(spark.read.parquet(out)).collect()}
    rows_in = raw.count()
    return {
        "metric": "raw table to labelled text", "value": round(end - start, 1), "unit": "sec",
        "base_table": round(ready - start, 1), "rows_in": rows_in, "columns_in": len(raw.columns),
        "cells_per_sec": round(rows_in * len(raw.columns) / (end - start)), "rows_out": rows, "cpus": cpus,
    }


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session("bench-wide", f"local[{cpus}]", cpus * 4, **{"spark.driver.memory": "20g"})
    spark.sparkContext.setLogLevel("ERROR")
    print(json.dumps(wide_text(spark, folder, cpus)))
    spark.stop()


if __name__ == "__main__":
    main()
