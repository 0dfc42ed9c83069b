"""Micro-batches from source to cleaned table: rules, quarantine, survivor and upsert, exactly once by run identity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quern.operators.quality import apply_rules, merge_quarantine, route_quarantine
from quern.operators.upsert import deduplicate
from quern.plans.contract import Contract, normalize
from quern.sources.store import TableStore, append_rows, upsert_table


def apply_batch(store: TableStore, contract: Contract, batch: DataFrame, run_id: str, ts: str, quarantine: str = "quarantine") -> dict:
    """One batch: valid rows are deduplicated and upserted, the others become dead letters. A run that is in the run
    table already is skipped, so a replayed batch changes nothing."""
    spark = batch.sparkSession
    runs = f"{contract.dataset}_runs"
    if store.current(runs) is not None and not store.read(runs).filter(F.col("run_id") == run_id).isEmpty():
        return {"run_id": run_id, "skipped": True}
    rows = normalize(batch, contract).persist()
    try:
        valid, bad = apply_rules(rows, (*contract.required_rules(), *contract.rules))
        names = [f.name for f in contract.fields]
        carried = [c for c in batch.columns if c.startswith("_") and c not in names]
        survivors = deduplicate(valid.select(*names, *carried), list(contract.keys), [ts, *contract.order])
        n = rows.count()
        n_bad = bad.count()
        letters = route_quarantine(bad, contract.dataset, run_id, list(contract.keys), names)
        if n_bad:
            upsert_quarantine(store, quarantine, letters)
        if n - n_bad:
            upsert_table(store, contract.dataset, survivors, list(contract.keys), ts, contract.partitions)
        append_rows(store, runs, spark.createDataFrame([(run_id, n, n_bad)], "run_id string, n_rows long, n_quarantined long"))
        return {"run_id": run_id, "skipped": False, "n_rows": n, "n_quarantined": n_bad}
    finally:
        rows.unpersist()


def upsert_quarantine(store: TableStore, table: str, letters: DataFrame) -> None:
    """Dead letters of known ids are merged in the parts that hold them; the others are a part of their own."""
    if store.current(table) is None:
        store.write(table, letters)
        return
    known = store.read(table).withColumn("_part", store.part_of()).join(letters.select("id"), "id", "left_semi")
    touched = [r._part for r in known.select("_part").distinct().collect()]  # of the version's parts
    made = merge_quarantine(store.read_parts(table, touched), letters) if touched else letters
    store.replace(table, touched, [store.write_part(table, made)])


def stream(source: DataFrame, store: TableStore, contract: Contract, ts: str, checkpoint: str, name: str) -> StreamingQuery:
    """Runs apply_batch over what a streaming source has now; the batch number is the run identity."""

    def each(batch: DataFrame, number: int) -> None:
        apply_batch(store, contract, batch, f"{name}-{number}", ts)

    return source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
