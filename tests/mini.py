"""Small hand-made inputs."""

from __future__ import annotations

import datetime as dt

from tillroll.schemas import EVENT_SCHEMA

HEADER = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n"
LINES = """\
2019-10-01 00:00:00 UTC,cart,5773203,1487580005134238553,,runail,2.62,463240011,26dd6e6e-4dac
2019-10-01 00:00:03 UTC,view,5773353,1487580005134238553,apparel.glove,runail,2.62,463240011,26dd6e6e-4dac
2019-10-01 00:00:03 UTC,cart,5773353,1487580005134238553,apparel.glove,runail,2.62,463240011,26dd6e6e-4dac
2019-10-01 00:00:07 UTC,cart,notanumber,1487580005134238553,a.b.c.d.e,,,463240011,
2019-10-01 00:00:07 UTC,cart,1,1487580005134238553,,lovely,-7.94,463240011,
2019-10-01 00:00:07 UTC,view,1,1487580005134238553,,lovely,-7.94,463240011,
"""
NEXT_MONTH = """\
2019-11-01 00:00:00 UTC,purchase,5773203,1487580005134238553,,runail,2.62,1,s1
2019-11-01 00:00:05 UTC,purchase,5773353,1487580005134238553,apparel.glove,renamed,3.00,1,s1
2019-11-02 00:00:00 UTC,purchase,5773353,1487580005134238553,apparel.glove,renamed,3.00,1,s1
"""


def write(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    path.write_text(text)
    return str(path)


def time(second: int, day: int = 1) -> dt.datetime:
    return dt.datetime(2019, 10, day, second // 3600, second // 60 % 60, second % 60)


def events(spark, rows):
    """Events from (time, type, product, price, user, session) tuples."""
    full = [(t, kind, product, 7, None, None, price, user, session) for t, kind, product, price, user, session in rows]
    return spark.createDataFrame(full, EVENT_SCHEMA)
