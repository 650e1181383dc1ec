import datetime as dt
from decimal import Decimal

TICKS = (
    "id long, time timestamp, symbol string, price decimal(20,8), volume decimal(30,8), bid decimal(20,8), "
    "ask decimal(20,8), exchange string, inserted_at timestamp"
)


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text if len(text) > 10 else f"{text} 00:00:00")


def tick(id, time, symbol="A", price="100", volume="1", bid=None, ask=None, exchange="x", inserted=None):
    dec = lambda v: None if v is None else Decimal(v)
    when = at(time) if isinstance(time, str) else time
    return (id, when, symbol, dec(price), dec(volume), dec(bid), dec(ask), exchange, inserted or when)


def ticks(spark, *rows):
    return spark.createDataFrame(list(rows), TICKS)


def rows(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))
