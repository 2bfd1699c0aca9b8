"""Feed descriptions: how one raw price feed maps to the common fields."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field, fields

from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

MEASURES = ("open", "high", "low", "close", "volume")


@dataclass(frozen=True)
class FeedSpec:
    """One price feed.

    name             prefix of its measures and name of its tables
    path             folder, file or glob of the raw CSV, relative to the input root
    schema           raw header names and types; None infers them with an extra pass
    renames          raw header name -> staging name
    ts_column        staging column with the event time
    ts_format        see functions.times.event_time
    measures         common field -> staging column
    drop_incomplete  drop rows with any missing value before anything else
    staging_table, series_table  names of its tables; by default staging_<name> and <name>_timeseries
    """

    name: str
    path: str
    schema: StructType | None
    measures: Mapping[str, str]
    renames: Mapping[str, str] = field(default_factory=dict)
    ts_column: str = "timestamp"
    ts_format: str = "epoch_s"
    drop_incomplete: bool = False
    staging_table: str = ""
    series_table: str = ""

    @property
    def staging_name(self) -> str:
        return self.staging_table or f"staging_{self.name}"

    @property
    def series_name(self) -> str:
        return self.series_table or f"{self.name}_timeseries"


def _schema(**types) -> StructType:
    return StructType([StructField(name, dtype) for name, dtype in types.items()])


# The header fields of the two public minute feeds.
BTC = FeedSpec(
    name="btc",
    path="btc_data",
    schema=_schema(
        **{
            "Timestamp": LongType(),
            "Open": DoubleType(),
            "High": DoubleType(),
            "Low": DoubleType(),
            "Close": DoubleType(),
            "Volume_(BTC)": DoubleType(),
            "Volume_(Currency)": DoubleType(),
            "Weighted_Price": DoubleType(),
        }
    ),
    renames={"Volume_(BTC)": "Volume_BTC", "Volume_(Currency)": "Volume_Currency"},
    ts_column="Timestamp",
    ts_format="epoch_s",
    measures={"open": "Open", "high": "High", "low": "Low", "close": "Close", "volume": "Volume_BTC"},
    drop_incomplete=True,
)

ETH = FeedSpec(
    name="eth",
    path="eth_data",
    schema=_schema(
        timestamp=StringType(),
        open=DoubleType(),
        high=DoubleType(),
        low=DoubleType(),
        close=DoubleType(),
        volume=DoubleType(),
        close_time=LongType(),
        quote_av=DoubleType(),
        trades=LongType(),
        tb_base_av=DoubleType(),
        tb_quote_av=DoubleType(),
        ignore=DoubleType(),
    ),
    ts_column="timestamp",
    ts_format="string_or_ms",
    measures={name: name for name in MEASURES},
)


def feeds_from_json(text: str) -> list[FeedSpec]:
    """Feeds from a JSON list of objects with the fields of FeedSpec; `schema` is a DDL string.

    `{"like": "btc"}` or `{"like": "eth"}` starts from that feed, so that only what differs is given.
    """
    known, names = {"btc": BTC, "eth": ETH}, {f.name for f in fields(FeedSpec)}
    specs = []
    for entry in json.loads(text):
        base = known[entry.pop("like")].__dict__ if "like" in entry else {}
        if unknown := set(entry) - names:
            raise ValueError(f"a feed has no fields {sorted(unknown)}")
        if isinstance(entry.get("schema"), str):
            entry["schema"] = StructType.fromDDL(entry["schema"])
        specs.append(FeedSpec(**{**base, **entry}))
    if len({s.name for s in specs}) < len(specs):
        raise ValueError("feeds need different names")
    return specs
