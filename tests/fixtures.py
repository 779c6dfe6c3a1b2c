"""Small hand-made league inputs for unit tests (own values)."""

import datetime as dt

from draftledger.params import Season
from draftledger.sources import schemas as S

SEASON = Season(year=1998, as_of=dt.date(1998, 12, 31))
D = dt.date


def ts(d):
    return dt.datetime.combine(d, dt.time())


def snapshot_rows(rows):
    """rows: (league, title, revenue, domestic, foreign, day, year_text)"""
    return [(lg, t, r, dm, fg, d, y, ts(d)) for lg, t, r, dm, fg, d, y in rows]


def models(spark, snapshots, draft, rules=(), manual=(), season=SEASON, **kw):
    from draftledger.plans.models import Models
    snap = spark.createDataFrame(snapshot_rows(snapshots), S.SNAPSHOT)
    dtext = spark.createDataFrame([tuple(None if v is None else str(v) for v in r) for r in draft], S.DRAFT_TEXT)
    rtext = spark.createDataFrame(list(rules), S.RULES_TEXT)
    mtext = spark.createDataFrame(list(manual), S.MANUAL_ADDS_TEXT)
    return Models(spark, season, snapshots=snap, draft_text=dtext, rules_text=rtext,
                  manual_adds_text=mtext, **kw)
