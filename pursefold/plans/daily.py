"""One day's run: source files to lake, lake day to the seven tables."""

from __future__ import annotations

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from operator import or_

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pursefold.functions.parsing import PARSERS
from pursefold.functions.rules import as_date
from pursefold.operators.audit import cell_metrics, key_faults, loss_metrics, refuse_repeated, require_key
from pursefold.operators.keyed import split_null_keys
from pursefold.operators.merge import merge_into_vouchers
from pursefold.plans import activity, profile, promotion
from pursefold.schemas import (
    ACTIVE,
    CAMPAIGNS,
    DAILY_ENTITIES,
    PAYMENT,
    PROMOTIONS,
    SUCCESS_STATUS,
    TARGETS,
    TRANSACTIONS,
    USER_APP,
    USER_INFO,
    USER_PMC,
    USER_PROMOTION,
    USERS,
    VOUCHER,
    Entity,
    Target,
)
from pursefold.sources import lake, tsv
from pursefold.sources.paths import delete
from pursefold.sources.state import StateStore


def store_date_for(run_date: dt.date) -> dt.date:
    """A run handles the day before it."""
    return run_date - dt.timedelta(days=1)


def day_flags(spark: SparkSession, source_root: str, store_date: dt.date | str) -> dict[str, bool]:
    """Which entities have rows for the day."""
    return {
        name: tsv.has_rows(spark, source_root, entity, store_date)
        for name, entity in DAILY_ENTITIES.items()
    }


def run_day(
    spark: SparkSession,
    source_root: str,
    lake_root: str,
    state: StateStore,
    store_date: dt.date | str,
    as_of: dt.date | str | None = None,
    mode: str = "fold",
    again: bool = False,
) -> DataFrame:
    """Bring the tables up to date with one day, entity by entity as far as it has data.

    Rows without a key are kept out of the tables. Returns (stage, n): per
    entity its rows in the lake, those rejected for want of a key, the cells
    lost to unreadable text and the rows with surplus or missing cells (their lines are kept, see
    ``lake.read_malformed``), and promotions of unknown campaigns; per table its rejected
    rows and its new size. All are counted by the jobs that write; a stage that Spark has to
    repeat may be counted twice. ``as_of`` is the day after ``store_date`` if not given.

    A table that has the day already is left as it is, so that a day cut off between tables can
    be repeated, in either mode; ``again`` merges a day that was delivered anew.
    """
    if as_of is None:  # the day the run is due
        as_of = dt.date.fromisoformat(str(store_date)) + dt.timedelta(days=1)
    known: dict[str, int] = {}

    def land(entity: Entity) -> DataFrame | None:
        """Write the day to the lake and give it back as later steps read it, if there is any."""
        if not tsv.has_rows(spark, source_root, entity, store_date):
            return None
        seen = Observation()
        path = tsv.day_path(source_root, entity, store_date)
        raw = tsv.read_raw(spark, path, entity, malformed=True).withColumn("store_date", as_date(store_date))
        watched = raw.observe(seen, *loss_metrics(entity), *cell_metrics(entity), *_row_metrics(entity))
        if entity is TRANSACTIONS:
            lake.write_clean_day(tsv.typed(watched, entity), lake_root, store_date)
        else:
            lake.write_raw_day(watched, lake_root, entity, store_date)
        found = seen.get
        for name in _row_metrics(entity, names=True):
            known[name] = found.pop(name)
        known.update({f"{entity.folder}.lost.{field}": n for field, n in found.items() if n})
        if found["surplus_cells"] or found["missing_cells"]:
            lake.write_malformed(raw, lake_root, entity)
        day = lake.read_lake_day(spark, lake_root, entity, store_date)
        return split_null_keys(day, entity.key)[0]

    def due(target: Target) -> bool:
        return again or not state.has_day(target, str(store_date))

    #: Beside the tables, for as long as the day runs.
    joined = f"{state.root}/claims-{uuid.uuid4().hex}"

    def claims_of(promotions: DataFrame, campaigns: DataFrame) -> DataFrame:
        """The day's claims with their campaigns, parsed and joined once for both tables that take them."""
        unknown = Observation()
        claims = promotion.voucher_claims(promotions, campaigns, unknown=unknown)
        claims.write.parquet(joined)
        if due(USER_PROMOTION):
            known[f"{PROMOTIONS.folder}.unknown_campaign"] = unknown.get["n"]
        return spark.read.schema(claims.schema).parquet(joined)

    # No table depends on another, nor does an entity, so their jobs may run side by side.
    with ThreadPoolExecutor(max_workers=len(TARGETS)) as pool:
        side_by_side = lambda f, items: list(pool.map(inheritable_thread_target(spark)(f), items))
        users, txn, promotions = side_by_side(land, DAILY_ENTITIES.values())
        #: Table, how it changes, the batch, and how the store applies it.
        updates = []
        if users is not None:
            updates += [(USER_INFO, lambda old: profile.profile_update(old, users), users, state.update)]
        if txn is not None:
            full = lambda target: split_null_keys(txn, target.key)[0]
            updates += [
                (PAYMENT, lambda old: activity.payment_update(old, txn, mode), activity.payments(txn), state.update),
                (ACTIVE, lambda old: activity.activity_update(old, txn, mode), txn, state.update),
                (USER_APP, lambda old: activity.user_apps_insert(old, txn), full(USER_APP), state.append),
                (USER_PMC, lambda old: activity.user_payment_sources_insert(old, txn), full(USER_PMC), state.append),
            ]
        if promotions is not None:
            campaigns = tsv.read_campaigns(spark, f"{source_root}/{CAMPAIGNS.folder}")
            faults = key_faults(campaigns, CAMPAIGNS.key).first()
            known[f"{CAMPAIGNS.folder}.rejected"] = faults.null_key_rows
            refuse_repeated(faults, CAMPAIGNS.key, CAMPAIGNS.folder)
            campaigns, _ = split_null_keys(campaigns, CAMPAIGNS.key)
            if due(USER_PROMOTION) or due(VOUCHER):
                claims = claims_of(promotions, campaigns)
                coded, _ = split_null_keys(claims, VOUCHER.key)
                updates += [
                    (USER_PROMOTION, lambda old: promotion.claims_update(old, claims, as_of), claims, state.update),
                    (VOUCHER, lambda old: merge_into_vouchers(old, coded), coded, state.update),
                ]

        def update(item):
            target, change, batch, apply = item
            if not due(target):
                return f"{target.name}.rows", None
            return f"{target.name}.rows", apply(target, change, str(store_date), batch)

        try:
            known.update((name, n) for name, n in side_by_side(update, updates) if n is not None)
        finally:
            delete(spark, joined)
    return spark.createDataFrame(list(known.items()), "stage string, n bigint")


def _row_metrics(entity: Entity, names: bool = False) -> list:
    """Counts over a day's raw rows, each under its stage's name: the rows that go into the lake, and
    those that tables reject for want of a key."""
    kinds = {f.name: PARSERS[f.kind](F.col(f.header)) for f in entity.fields}
    stored = kinds["trans_status"] == SUCCESS_STATUS if entity is TRANSACTIONS else F.lit(True)

    def missing(key):
        return reduce(or_, [kinds[k].isNull() for k in key])

    keyed = stored & ~missing(entity.key)
    counts = {f"{entity.folder}.rows": stored, f"{entity.folder}.rejected": stored & missing(entity.key)}
    for target in {TRANSACTIONS: (USER_APP, USER_PMC), PROMOTIONS: (VOUCHER,)}.get(entity, ()):
        counts[f"{target.name}.rejected"] = keyed & missing(target.key)
    return list(counts) if names else [F.count_if(met).alias(name) for name, met in counts.items()]


def load_history(
    spark: SparkSession,
    lake_root: str,
    state: StateStore,
    campaigns: DataFrame | None = None,
    as_of: dt.date | str | None = None,
    promotions: bool = False,
) -> dict[str, int]:
    """Publish the tables once from all days of the lake, and return their sizes.

    Rows without a key stay out. With ``promotions`` (then ``campaigns`` and ``as_of`` are
    needed) the promotion and voucher tables are loaded as well.
    """
    users, _ = split_null_keys(lake.read_lake(spark, lake_root, USERS), USERS.key)
    txn, _ = split_null_keys(lake.read_lake(spark, lake_root, TRANSACTIONS), TRANSACTIONS.key)
    users, txn = users.drop("store_date"), txn.drop("store_date")
    loads = [
        (USER_INFO, profile.latest_profile(users)),
        (PAYMENT, activity.first_last_payment(txn)),
        (ACTIVE, activity.first_last_activity(txn)),
        (USER_APP, activity.user_apps(split_null_keys(txn, USER_APP.key)[0])),
        (USER_PMC, activity.user_payment_sources(split_null_keys(txn, USER_PMC.key)[0])),
    ]
    if promotions:
        claims, _ = split_null_keys(lake.read_lake(spark, lake_root, PROMOTIONS), PROMOTIONS.key)
        claims = claims.drop("store_date")
        require_key(campaigns, CAMPAIGNS.key, CAMPAIGNS.folder)
        loads += [
            (USER_PROMOTION, promotion.latest_promotion(claims, campaigns, as_of)),
            (VOUCHER, promotion.voucher_update(claims, claims.limit(0), campaigns)),
        ]
    with ThreadPoolExecutor(max_workers=len(loads)) as pool:
        load = inheritable_thread_target(spark)(lambda item: (item[0].name, state.publish(item[1], item[0])))
        return dict(pool.map(load, loads))
