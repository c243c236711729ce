from __future__ import annotations

import datetime as dt

from wakeline.operators import voyages
from wakeline.rules import VoyageRules
from wakeline.schema import POSITION_SCHEMA
from wakeline.sources.tables import layer_path, read_positions, write_partitioned
from wakeline.streaming.voyages import stream_positions, stream_voyages

RULES = VoyageRules(gap_hours=4.0, min_points=2)


def positions(spark, rows):
    filled = [
        {**{n: None for n in POSITION_SCHEMA.names}, "mmsi": m, "event_time": t, "latitude": 1.0,
         "longitude": float(i), "sog": 3.0, "source_date": t.date().isoformat()}
        for i, (m, t) in enumerate(rows)
    ]
    return spark.createDataFrame(filled, POSITION_SCHEMA)


def test_stream_gives_the_closed_voyages_of_the_batch(spark, tmp_path):
    root, out, checkpoint = str(tmp_path / "root"), str(tmp_path / "out"), str(tmp_path / "cp")
    day = dt.datetime(2025, 8, 15)
    silver = layer_path(root, "vessel_positions")

    def drain():
        stream = stream_voyages(stream_positions(spark, root), RULES, watermark="1 hour")
        (
            stream.writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(availableNow=True).start().awaitTermination(180)
        )

    hours = [0, 1, 5, 5.5, 10, 11]  # exactly four hours apart stays, more splits
    first = [(366000001, day + dt.timedelta(hours=h)) for h in hours]
    write_partitioned(positions(spark, first), silver, ["source_date"])
    drain()
    later = [(366000002, day + dt.timedelta(days=2, hours=h)) for h in (0, 1)]
    write_partitioned(positions(spark, later), silver, ["source_date"])
    drain()
    # a day that is run again is read again and changes nothing
    write_partitioned(positions(spark, later), silver, ["source_date"])
    drain()

    want = voyages.voyage_candidates(read_positions(spark, root), RULES)
    assert want.count() == 3
    closed = want.where("mmsi = 366000001")
    got = spark.read.schema(closed.schema).parquet(out)
    assert got.exceptAll(closed).count() == closed.exceptAll(got).count() == 0
