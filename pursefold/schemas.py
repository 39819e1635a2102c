"""Input entities and target tables.

Each input field has the header it carries in the daily files, the name used
everywhere else, and a kind saying how its text is read (see
``functions.parsing.PARSERS``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    header: str
    name: str
    kind: str


@dataclass(frozen=True)
class Entity:
    folder: str
    fields: tuple[Field, ...]
    key: tuple[str, ...]

    @property
    def raw_schema(self) -> T.StructType:
        """Every column as text, under its file header, in file order."""
        return T.StructType([T.StructField(f.header, T.StringType()) for f in self.fields])


@dataclass(frozen=True)
class Target:
    name: str
    key: tuple[str, ...]
    columns: dict[str, str]

    @property
    def names(self) -> list[str]:
        return list(self.columns)

    @property
    def ddl(self) -> str:
        return ", ".join(f"{name} {kind}" for name, kind in self.columns.items())


#: Column with the whole line of a row that has more or fewer cells than the header; NULL for all other rows.
MALFORMED = "malformed_line"

# Folder names and file headers of the daily feeds.
USERS = Entity(
    "users",
    (
        Field("userid", "user_id", "text"),
        Field("birthdate", "birthdate", "date"),
        Field("profileLevel", "profile_level", "int"),
        Field("gender", "gender", "int"),
        Field("updatedTime", "updated_time", "time"),
    ),
    key=("user_id",),
)
TRANSACTIONS = Entity(
    "transactions",
    (
        Field("transid", "trans_id", "text"),
        Field("transStatus", "trans_status", "int"),
        Field("userId", "user_id", "text"),
        Field("transactionTime", "txn_time", "time"),
        Field("appId", "app_id", "int"),
        Field("transType", "trans_type", "int"),
        Field("amount", "amount", "long"),
        Field("pmcId", "pmc_id", "int"),
    ),
    key=("user_id",),
)
PROMOTIONS = Entity(
    "promotions",
    (
        Field("userid", "user_id", "text"),
        Field("voucherCode", "voucher_code", "text"),
        Field("status", "status", "text"),
        Field("campaignID", "campaign_id", "long"),
        Field("time", "time_s", "epoch"),
    ),
    key=("user_id", "campaign_id"),
)
CAMPAIGNS = Entity(
    "configs",
    (
        Field("campaignID", "campaign_id", "long"),
        Field("campaignType", "campaign_type", "int"),
        Field("expireDate", "expire_date", "time"),
        Field("expireTime", "expire_secs", "long"),
    ),
    key=("campaign_id",),
)
DAILY_ENTITIES = {e.folder: e for e in (USERS, TRANSACTIONS, PROMOTIONS)}

# Meaning of the codes in the feeds.
SUCCESS_STATUS = 1
PAYMENT_TYPE = 3
EARLIER_EXPIRY_CAMPAIGN = 2

USER_INFO = Target(
    "user_info",
    ("user_id",),
    {
        "user_id": "string",
        "birthdate": "date",
        "profile_level": "int",
        "gender": "int",
        "updated_time": "timestamp",
    },
)
PAYMENT = Target(
    "payment",
    ("user_id",),
    {
        "user_id": "string",
        "first_payment_time": "timestamp",
        "last_payment_time": "timestamp",
        "last_payment_app": "int",
        "last_payment_id": "string",
    },
)
ACTIVE = Target(
    "active",
    ("user_id",),
    {
        "user_id": "string",
        "first_active_time": "timestamp",
        "last_active_time": "timestamp",
        "last_trans_type": "int",
        "last_active_id": "string",
    },
)
USER_APP = Target("user_app", ("user_id", "app_id"), {"user_id": "string", "app_id": "int"})
USER_PMC = Target("user_pmc", ("user_id", "pmc_id"), {"user_id": "string", "pmc_id": "int"})
USER_PROMOTION = Target(
    "user_promotion",
    ("user_id", "campaign_id"),
    {
        "user_id": "string",
        "campaign_id": "bigint",
        "status": "string",
        "expired": "boolean",
    },
)
# Kept per voucher rather than per user.
VOUCHER = Target(
    "voucher",
    ("voucher_code",),
    {
        "voucher_code": "string",
        "user_id": "string",
        "campaign_id": "bigint",
        "status": "string",
        "time_s": "bigint",
        "actual_expire": "timestamp",
    },
)
TARGETS = {
    t.name: t
    for t in (USER_INFO, PAYMENT, ACTIVE, USER_APP, USER_PMC, USER_PROMOTION, VOUCHER)
}
