"""Which handler a file goes to, and what becomes of files without one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterflow import schemas as S
from rosterflow.functions import text

HANDLERS = {"PROVIDER": "org_provider", "FACILITY": "org_facility"}


def handler(file_type: Column) -> Column:
    """Kind of rows a file type holds; null when there is no handler."""
    return F.when(file_type == "PROVIDER", HANDLERS["PROVIDER"]).when(file_type == "FACILITY", HANDLERS["FACILITY"])


def refusal(file_type: Column) -> Column:
    """Error message of a file type without a handler; null for the others."""
    return F.when(file_type == "BENEFICIARY", S.MSG_BENEFICIARY).when(
        handler(file_type).isNull(), F.concat(F.lit(S.MSG_UNKNOWN_TYPE + "'"), text.shown(file_type), F.lit("'"))
    )


def outcome_status(error: Column) -> Column:
    return F.when(error.isNull(), "COMPLETED").otherwise("FAILED")


def unexpected(problem: Column) -> Column:
    return F.concat(F.lit(S.MSG_UNEXPECTED), problem)
