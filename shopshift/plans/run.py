"""Run the migration: read legacy tables, run the jobs, write every target, publish all at once.

Stages that several targets read (staged orders, repaired history) are
written to the session's shared checkpoint folder, so each is computed once
and survives executor loss; everything else stays lazy and Spark plans each
target write as one job.  A journal notes finished stages and targets: a run
that failed can be resumed, and what a run leaves behind goes when it, or a
later one, is published.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopshift.config import MigrationConfig
from shopshift.functions import predicates as P
from shopshift.operators.idmap import KeyConflict, refuse_conflicts  # noqa: F401 (KeyConflict: what migrate may raise)
from shopshift.operators.ledger import Ledger
from shopshift.plans import customers as CU
from shopshift.plans import orders as O
from shopshift.plans import products as PR
from shopshift.plans import reconcile as RC
from shopshift.plans import reviews as RV
from shopshift.plans.journal import Journal, clean_up, fingerprint
from shopshift.schemas import target_schema
from shopshift.sinks.writers import append_union, commit_run, publish, write_version
from shopshift.sources.tables import Stages, folder_size, last_run, live_folders, load_table, materialise, read_folders, stages_of

LEGACY_TABLES = (
    "customers address_book zones countries products products_description orders orders_total orders_products "
    "orders_products_attributes orders_status_history orders_status_history_transactions reviews reviews_description"
).split()

TARGET_INPUTS = (
    "eav_attribute eav_attribute_set eav_attribute_group catalog_product_entity catalog_product_entity_varchar "
    "catalog_category_entity_varchar catalog_product_id_map rating rating_option"
).split()

# Catalogue tables that keep the rows of entities a run does not delete, and their entity column.
ENTITY_TABLES = {
    "catalog_product_entity_varchar": "entity_id",
    "catalog_product_entity_decimal": "entity_id",
    "catalog_product_entity_int": "entity_id",
    "catalog_product_entity_text": "entity_id",
    "catalog_category_product": "product_id",
}
# Other tables that are appended to: rows whose key a run writes again are replaced.
ROW_KEYS = {
    "eav_entity_attribute": ["attribute_id", "attribute_set_id"],
    "review_detail": ["review_id", "store_id"],
    "review_store": ["review_id", "store_id"],
    "rating_option_vote": ["review_id", "option_id"],
}
# All other targets are complete snapshots.

#: Folders that a version names at most; beyond, the smallest are written as one.
MAX_FOLDERS = 8


def read_legacy(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    return read_targets(spark, base, LEGACY_TABLES)


def read_targets(spark: SparkSession, base: str, names=None) -> dict[str, DataFrame]:
    """Those of the named tables that exist, as they are now."""
    return {n: load_table(spark, base, n) for n in names or TARGET_INPUTS if live_folders(spark, _path(base, n))}


def _path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def migrate(
    spark: SparkSession,
    legacy_base: str,
    target_base: str,
    cfg: MigrationConfig | None = None,
    jobs: Iterable[str] = ("customers", "addresses", "orders", "catalog", "legacy_products", "reviews", "reconcile"),
    resume: bool = False,
) -> dict[str, str]:
    """Run the selected jobs and write their targets; returns table -> folder written.

    A run replaces what an earlier run of the same jobs wrote: flagged
    entities (catalog), entities of the legacy set (legacy_products), and all
    values of either.  Every other entity and its values stay.  All tables are
    written first and then published by one record: a reader sees all tables
    of the last run or all of this one.  If another run was published in the
    meantime this one fails (``RunConflict``) and counts for nothing.

    ``resume`` goes on with a run of the same parameters on the same tables
    that did not end (and is not running any more): the stages and targets it
    finished are not written again.
    """
    cfg = cfg or MigrationConfig()
    jobs = list(jobs)
    number = last_run(spark, target_base) + 1
    read = [_path(legacy_base, n) for n in LEGACY_TABLES] + [_path(target_base, n) for n in TARGET_INPUTS]
    journal = Journal.open(spark, target_base, fingerprint(spark, cfg, jobs, read, number), resume)
    with stages_of(Stages(spark, journal.run_id, journal)):
        written, folders = _write_all(spark, legacy_base, target_base, cfg, jobs, journal)
    for name, own in folders.items():
        publish(spark, _path(target_base, name), own, journal.run_id, number)
    commit_run(spark, target_base, number, journal.run_id, list(folders))
    clean_up(spark, target_base, journal.run_id)
    return written


def _write_all(
    spark: SparkSession, legacy_base: str, target_base: str, cfg: MigrationConfig, jobs: list[str], journal: Journal
) -> tuple[dict[str, str], dict[str, list[str]]]:
    """Write the targets of the jobs; returns table -> folder written, and table -> all folders of its next version."""
    src = read_legacy(spark, legacy_base)
    tgt = read_targets(spark, target_base)
    outputs: dict[str, list[DataFrame]] = {}
    ledger = Ledger()

    def add(d: dict[str, DataFrame]) -> None:
        for k, v in d.items():
            outputs.setdefault(k, []).append(v)

    if "customers" in jobs:
        add(CU.customers_job(src, cfg))
    if "addresses" in jobs:
        add(CU.addresses_job(src, cfg, materialise_stages=True))
    if "orders" in jobs:
        add(O.orders_job(src, cfg, materialise_stages=True, ledger=ledger))

    removed = None
    entities = tgt.get("catalog_product_entity")
    if entities is not None:
        goes = F.lit(False)
        if "catalog" in jobs:
            goes = goes | F.coalesce(P.ends_with("sku", cfg.migrate_flag), F.lit(False))
        if "legacy_products" in jobs:
            old = tgt["eav_attribute_set"].filter(P.equals("attribute_set_name", cfg.legacy_set_name)).select("attribute_set_id")
            # one row per set of that name
            goes = goes | F.coalesce(F.col("attribute_set_id").isin([r[0] for r in old.distinct().collect()]), F.lit(False))
        removed = materialise(entities.filter(goes).select("entity_id"))
        entities = tgt["catalog_product_entity"] = entities.filter(~goes)
    if "catalog" in jobs:
        add(PR.catalog_job(src, tgt, cfg, materialise_stages=True, ledger=ledger))
    legacy_set_id = None
    if "legacy_products" in jobs:
        legacy = PR.legacy_products_job(src, tgt, cfg, materialise_stages=True, ledger=ledger)
        legacy_ids = PR.legacy_products(src, cfg).select(F.col("products_id").alias("entity_id"))
        if "catalog" in jobs:
            refuse_conflicts(legacy_ids, outputs["catalog_product_id_map"][0], "legacy product")
        if entities is not None:
            refuse_conflicts(legacy_ids, entities, "legacy product")
            if "catalog" not in jobs:
                outputs.setdefault("catalog_product_entity", []).insert(0, entities)
        sets = legacy["eav_attribute_set"]
        legacy_set_id = sets.filter(sets["attribute_set_name"] == cfg.legacy_set_name).head()["attribute_set_id"]
        add(legacy)
    if "reviews" in jobs:
        add(RV.reviews_job(src, tgt, cfg, materialise_stages=True))

    if ledger.entries:
        outputs["migration_ledger"] = [ledger.frame(spark)]
    written, folders = {}, {}

    def write(name: str, df: DataFrame) -> None:
        note = journal.finished("target", name)
        if note is None:
            path = _path(target_base, name)
            kept = bounded(spark, path, kept_folders(spark, path, name, df, removed, journal.run_id), journal.run_id)
            own = write_version(df, path, target_schema(name), journal.run_id)
            note = {"written": own, "folders": [*kept, own], "wrote": [own, *[f for f in kept if journal.run_id in f]]}
            journal.finish("target", name, note)
        written[name], folders[name] = note["written"], note["folders"]

    for name, parts in outputs.items():
        write(name, append_union(parts))
    if "reconcile" in jobs and legacy_set_id is not None:
        # the record compares with the catalogue as this run leaves it
        after = {n: read_folders(spark, folders[n]) for n in ("catalog_product_entity", "catalog_product_entity_varchar")}
        for name, df in RC.reconciliation_job(src, after, cfg, legacy_set_id).items():
            write(name, df)
    return written, folders


def kept_folders(spark: SparkSession, path: str, name: str, new: DataFrame, removed: DataFrame | None, run_id: str) -> list[str]:
    """The folders of the table's present version whose rows stay beside ``new``.

    A folder without a row to delete is kept as it is, after a look at its key
    columns alone; one with such rows is written again without them, or left
    out if nothing stays.  A snapshot table keeps none.
    """
    if name not in ENTITY_TABLES and name not in ROW_KEYS:
        return []
    keys = [ENTITY_TABLES[name]] if name in ENTITY_TABLES else ROW_KEYS[name]
    if name in ENTITY_TABLES:
        gone = removed.withColumnRenamed("entity_id", keys[0]) if removed is not None else None
    else:
        gone = new.select(*keys).distinct()
    out = []
    for i, folder in enumerate(live_folders(spark, path)):
        rows = spark.read.parquet(folder)
        if gone is None or rows.join(gone, keys, "left_semi").select(*keys).isEmpty():
            out.append(folder)
            continue
        stays = rows.join(gone, keys, "left_anti").select(*rows.columns)
        if not stays.isEmpty():
            out.append(write_version(stays, path, name=f"{run_id}-kept{i}"))
    return out


def bounded(spark: SparkSession, path: str, folders: list[str], run_id: str) -> list[str]:
    """``folders``, the smallest written as one if there are more than a version may name beside its new one."""
    if len(folders) < MAX_FOLDERS:
        return folders
    # half of the places stay free, so a run in MAX_FOLDERS / 2 merges, and large folders are seldom written again
    by_size = sorted(folders, key=lambda f: folder_size(spark, f)[0])
    small = by_size[: len(folders) - MAX_FOLDERS // 2 + 1]
    merged = write_version(read_folders(spark, small), path, name=f"{run_id}-merged")
    return [f for f in folders if f not in small] + [merged]
