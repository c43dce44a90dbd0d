"""Audit of recorded statement runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drayage.functions.classify import classify_statement
from drayage.functions.text import error_text
from drayage.operators import statements as st


def run_audit(runs: DataFrame, lines: DataFrame, prefix: str) -> DataFrame:
    """One row per statement: its class, its value's status, its error type and message.

    ``runs`` has stmt_id, state and output{status, data, ename, evalue, traceback};
    ``lines`` the output lines (stmt_id, pos, line) of the same statements.
    """
    output = F.col("output")
    judged = runs.select(
        "stmt_id",
        classify_statement(F.col("state"), output).alias("class"),
        output["ename"].alias("ename"),
        output["evalue"].alias("evalue"),
        output["traceback"].alias("traceback"),
    )
    values = st.first_frame(lines, prefix).select(
        "stmt_id", F.col("status").alias("value_status"), F.octet_length("data").alias("value_bytes")
    )
    failed = F.col("class") == "error"
    return (
        st.classify_errors(judged.join(values, "stmt_id", "left"))
        .select(
            "stmt_id",
            "class",
            F.when(F.col("class") == "ok", F.coalesce("value_status", F.lit("no_frame")))
            .alias("value_status"),
            F.when(F.col("class") == "ok", F.col("value_bytes")).alias("value_bytes"),
            F.when(failed, F.col("error_type")).alias("error_type"),
            F.when(failed, error_text(F.col("ename"), F.col("evalue"), F.col("traceback")))
            .alias("message"),
        )
    )
