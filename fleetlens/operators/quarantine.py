"""Bad rows kept apart with the reasons (Q18): no row is lost and no bad value stops a job.

Incoming trip events are text. Every field is parsed with a ``try_*`` function, so a malformed
value gives null instead of an error; a null that was not null in the text, a missing key, an
event code that is no eight hex digits and times in the wrong order each have a reason code. Rows
without a reason go on, typed; the others keep their text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

KEYS = ("CompanyID", "VehicleID", "TripEventID", "TripEventGuid")
PARSED = {"CompanyID": "bigint", "Timestamp": "timestamp", "CreatedDate": "timestamp", "Speed": "double"}
CODE = r"^[0-9a-fA-F]{8}_"


def reasons(parsed: dict[str, str] = PARSED, keys=KEYS) -> Column:
    """Sorted array of the reason codes of a row of text columns; empty for a good row."""
    found = [F.when(F.col(k).isNull() | (F.trim(F.col(k)) == ""), F.lit(f"missing {k}")) for k in keys]
    found += [F.when(F.col(c).isNotNull() & (F.trim(F.col(c)) != "") & F.col(c).try_cast(t).isNull(), F.lit(f"malformed {c}")) for c, t in parsed.items()]
    found.append(F.when(F.col("TripEventID").isNotNull() & (F.trim("TripEventID") != "") & ~F.col("TripEventID").rlike(CODE), F.lit("malformed TripEventID")))
    found.append(F.when(F.col("CreatedDate").try_cast("timestamp") < F.col("Timestamp").try_cast("timestamp"), F.lit("created before event")))
    return F.array_sort(F.array_compact(F.array(*found)))


def split_rows(raw: DataFrame, parsed: dict[str, str] = PARSED) -> tuple[DataFrame, DataFrame]:
    """(typed good rows, rows in quarantine with ``reasons``); together they are all rows of ``raw``."""
    tagged = raw.withColumn("reasons", reasons(parsed))
    good = tagged.where(F.size("reasons") == 0).drop("reasons")
    return good.withColumns({c: F.col(c).try_cast(t) for c, t in parsed.items()}), tagged.where(F.size("reasons") > 0)
