"""Event x sensor-series interval join.

Samples carry no event id: they belong to an event by (CompanyID, VehicleID) and a time
range around the event timestamp. Joining on the vehicle alone degrades to
events-per-vehicle x samples-per-vehicle comparisons, which grows without bound for a busy
vehicle. We add a time-bucket equi key instead:

* each event gets one *home bucket* ``floor(ts / bucket_s)``;
* each sample is replicated to the (1 or 2) home buckets of events whose range can hold it;
* samples that no event of their vehicle can reach are dropped before the shuffle (``near_events``):
  a family's events are a part of all events, and the samples of the others need not travel.

The join is then an equi join on (CompanyID, VehicleID, _bucket) with the exact range as a
residual filter, so each (event, sample) pair is produced exactly once and candidate lists
stay bounded by ``bucket_s`` worth of samples. Because ``_bucket`` is a function of the event,
the join's hash partitioning on (CompanyID, VehicleID, _bucket) also satisfies every later
per-event Window / groupBy keyed by ``EVENT_PART`` — no second shuffle of the joined rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# per-event partition key used by downstream windows / aggregates (join keys + event id)
EVENT_PART = ("CompanyID", "VehicleID", "_bucket", "TripEventID")
_US = 1_000_000

# the filter of ``near_events``: at most FILTER_ROWS rows of FILTER_WORDS 64-bit words, 8 MB of bits
FILTER_ROWS, FILTER_WORDS = 65_536, 16


def _placed(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with the place of its ``keys`` in the filter: row, word and bit."""
    place = F.pmod(F.xxhash64(*keys), F.lit(FILTER_ROWS * FILTER_WORDS * 64))
    return df.withColumn("_place", place).withColumns({
        "_slot": F.floor(F.col("_place") / (FILTER_WORDS * 64)),
        "_word": F.floor(F.col("_place") / 64 % FILTER_WORDS).cast("int"),
        "_bit": (F.col("_place") % 64).cast("int")}).drop("_place")


def near_events(samples: DataFrame, events: DataFrame, lo_s: int, hi_s: int, event_ts: str, sample_ts: str,
                keys: tuple[str, ...]) -> DataFrame:
    """The samples that an event of the same ``keys`` can reach, and some others: a semi join by a hashed bitmap.

    Time is cut into cells of four ranges; an event sets the bits of the one or two cells it reaches
    (wider cells set fewer bits, narrower ones pass fewer samples), a sample looks up its own. The bitmap comes from one aggregate of the events and is
    broadcast; its size is bounded by ``FILTER_ROWS`` whatever the table (8 MB and the row headers).
    What passes by chance (the share of set bits: an eighth at 7 million events) meets no event in the
    join that follows, so the join's rows are the same.
    """
    cell = 4 * max(hi_s - lo_s, 1) * _US
    e_us, p_us = F.unix_micros(event_ts), F.unix_micros(sample_ts)
    reached = F.sequence(F.floor((e_us + lo_s * _US) / cell), F.floor((e_us + hi_s * _US) / cell))
    by = [*keys, "_cell"]
    ev = _placed(events.select(*keys, F.explode(reached).alias("_cell")), by)
    words = [F.bit_or(F.when(F.col("_word") == i, F.expr("shiftleft(1L, _bit)")).otherwise(F.lit(0).cast("long")))
             for i in range(FILTER_WORDS)]
    bitmap = ev.groupBy("_slot").agg(F.array(*words).alias("_words"))
    sm = _placed(samples.withColumn("_cell", F.floor(p_us / cell)), by)
    hit = F.expr("shiftright(get(_words, _word), _bit) & 1") == 1
    return bitmap.hint("broadcast").join(sm, "_slot").where(hit).select(*samples.columns)


def interval_join(events: DataFrame, samples: DataFrame, lo_s: int, hi_s: int,
                  inclusive: bool = False, bucket_s: int = 240,
                  event_ts: str = "EventTimeStamp", sample_ts: str = "ppeTimeStamp",
                  keys: tuple[str, ...] = ("CompanyID", "VehicleID")) -> DataFrame:
    """Inner join of events with samples where ``event_ts + lo_s (<|<=) sample_ts (<|<=) event_ts + hi_s``.

    ``events`` and ``samples`` must share only ``keys``; the sample side should carry
    ``SequenceID`` to get ``TimeSegment`` / ``SecTimeSegment`` (seconds crossed since the event
    plus a quarter second per sequence step).

    One plan at every size: an equi join on (keys, home bucket), shuffled, with a hash table of the
    events of a task; AQE splits skewed tasks. The samples are many times the events, but Spark's
    size estimate does not know what ``explode`` makes of a row: without the hint it would broadcast
    them through the driver. They are not sorted before the join either (a merge join sorts, and
    spills, all of them to keep a part). The plan of ``events`` runs twice: for the filter of the
    samples and for the join.
    """
    if bucket_s <= 0 or hi_s < lo_s:
        raise ValueError("need bucket_s > 0 and lo_s <= hi_s")
    width = bucket_s * _US
    ev = events.withColumn("_bucket", F.floor(F.unix_micros(event_ts) / width))
    e_us, p_us = F.unix_micros(F.col(event_ts)), F.unix_micros(F.col(sample_ts))
    if inclusive:
        cond = (p_us >= e_us + lo_s * _US) & (p_us <= e_us + hi_s * _US)
    else:
        cond = (p_us > e_us + lo_s * _US) & (p_us < e_us + hi_s * _US)
    # each sample goes to the home buckets of the events that can reach it; the output's hash
    # partitioning serves every per-event Window / aggregate downstream without another shuffle
    first = F.floor((p_us - hi_s * _US) / width)
    last = F.floor((p_us - lo_s * _US) / width)
    near = near_events(samples, events, lo_s, hi_s, event_ts, sample_ts, keys)
    sm = near.withColumn("_bucket", F.explode(F.sequence(first, last)))
    joined = ev.hint("shuffle_hash").join(sm, on=[*keys, "_bucket"], how="inner").where(cond)
    if "SequenceID" in samples.columns:
        secs = (F.floor(p_us / _US) - F.floor(e_us / _US))
        joined = joined.withColumns({
            "TimeSegment": F.concat(secs.cast("string"), F.lit("."), F.col("SequenceID").cast("string")),
            "SecTimeSegment": secs.cast("double") + (F.col("SequenceID") - 1).cast("double") * F.lit(0.25),
        })
    return joined


def naive_interval_join(events: DataFrame, samples: DataFrame, lo_s: int, hi_s: int,
                        inclusive: bool = False, event_ts: str = "EventTimeStamp",
                        sample_ts: str = "ppeTimeStamp",
                        keys: tuple[str, ...] = ("CompanyID", "VehicleID")) -> DataFrame:
    """Reference plan: equi join on the vehicle with the range as residual (for benchmarks)."""
    e_us, p_us = F.unix_micros(F.col(event_ts)), F.unix_micros(F.col(sample_ts))
    if inclusive:
        cond = (p_us >= e_us + lo_s * _US) & (p_us <= e_us + hi_s * _US)
    else:
        cond = (p_us > e_us + lo_s * _US) & (p_us < e_us + hi_s * _US)
    return events.join(samples, on=list(keys), how="inner").where(cond)
