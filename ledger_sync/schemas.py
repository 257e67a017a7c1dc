"""Column lists, fixed values, cleaning presets and warehouse types."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

USERS = "users"
TRANSACTIONS = "transactions"
METADATA = "updatemetadata"

USER_COLUMNS = ("userid", "name", "contact", "balance")
TRANSACTION_COLUMNS = ("transactionid", "userid", "amount", "type", "date", "status", "method")
# Column order of the transactions sink: the user reference comes last.
TRANSACTION_SINK_COLUMNS = (
    "transactionid", "amount", "type", "date", "status", "method", "userid",
)

# The texts that mean "missing" in a CSV extract.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# What replaces a missing value, per table.
USER_FILLS = {"name": "unknown", "contact": "not provided", "balance": 0.0}
TRANSACTION_FILLS = {
    "amount": 0.0, "type": "unknown", "status": "unknown", "method": "not specified",
}
INVALID_CONTACT = "not provided"

# The forms of a whole and of a decimal number in a CSV extract.
WHOLE_PATTERN = r"^\s*[+-]?[0-9]{1,19}(?:\.0*)?\s*$"
NUMBER_PATTERN = (
    r"^\s*[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|(?i:inf(?:inity)?))\s*$"
)

# A contact is ten decimal digits of any script.
# (?U) makes \d match Unicode digits, (?d) makes $ accept a trailing \n only.
CONTACT_PATTERN = r"(?Ud)^\d{10}$"

# The forms of a date. All dates of an extract have the form of the first one.
_DAY, _TIME = r"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}", r"[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}"
DATE_FORM = "yyyy-MM-dd HH:mm:ss"
DATE_FORMS = {
    DATE_FORM: rf"^{_DAY} {_TIME}\z",
    "yyyy-MM-dd HH:mm:ss.f": rf"^{_DAY} {_TIME}\.[0-9]{{1,9}}\z",
    "yyyy-MM-ddTHH:mm:ss": rf"^{_DAY}T{_TIME}\z",
    "yyyy-MM-ddTHH:mm:ss.f": rf"^{_DAY}T{_TIME}\.[0-9]{{1,9}}\z",
    "yyyy-MM-dd HH:mm": rf"^{_DAY} [0-9]{{1,2}}:[0-9]{{1,2}}\z",
    "yyyy-MM-ddTHH:mm": rf"^{_DAY}T[0-9]{{1,2}}:[0-9]{{1,2}}\z",
    "yyyy-MM-dd": rf"^{_DAY}\z",
}
# The dates that 64-bit nanoseconds can count.
FIRST_DATE, LAST_DATE = "1677-09-21 00:12:44", "2262-04-11 23:47:16"

# The control row and the high-water mark of a fresh warehouse.
CONTROL_ID = 1
SEED_WATERMARK = "2024-08-20 00:00:00"

# Working columns of a landed extract. The first three give the position in file order.
FILE, BLOCK, ROW = "_file", "_block", "_row"
FILE_ORDER = (FILE, BLOCK, ROW)
REASON, RECORD = "reject_reason", "reject_record"
# Whether a transaction has a date that could not be taken.
UNDATED = "_undated"


@dataclass(frozen=True)
class Preset:
    """Cleaning rules that differ between the variants of the pipeline."""

    name: str
    contact_policy: str = "replace"
    max_amount: float | None = None

    def __post_init__(self) -> None:
        if self.contact_policy not in ("replace", "drop"):
            raise ValueError(f"contact_policy must be replace or drop: {self.contact_policy}")


SCRIPT = Preset("script")
SCRIPT_CAPPED = Preset("script_capped", max_amount=10000.0)
DAG = Preset("dag", contact_policy="drop", max_amount=10000.0)
PRESETS = {p.name: p for p in (SCRIPT, SCRIPT_CAPPED, DAG)}


@dataclass(frozen=True)
class Limits:
    """Warehouse column types. ``key_type="bigint"`` lifts the 32-bit id range."""

    key_type: str = "int"
    money: str = "decimal(10,2)"
    name_length: int = 100
    text_length: int = 50

    def users(self) -> T.StructType:
        return T.StructType.fromDDL(
            f"userid {self.key_type} not null, name string, contact string, balance {self.money}"
        )

    def transactions(self) -> T.StructType:
        return T.StructType.fromDDL(
            f"transactionid {self.key_type} not null, amount {self.money}, type string, "
            f"date timestamp_ntz, status string, method string, userid {self.key_type}"
        )

    def metadata(self) -> T.StructType:
        return T.StructType.fromDDL("id int not null, last_update_date timestamp_ntz not null")


DEFAULT_LIMITS = Limits()
