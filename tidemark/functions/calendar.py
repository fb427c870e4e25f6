"""NYSE sessions from the exchange's public rules, as a small dimension and as gate decisions."""

from __future__ import annotations

import re
from datetime import UTC, date, datetime, time, timedelta
from functools import lru_cache
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession

NEW_YORK = ZoneInfo("America/New_York")
#: Closures by decree; add to it as they occur.
AD_HOC = {date(2018, 12, 5), date(2025, 1, 9)}


def _nth(year: int, month: int, weekday: int, n: int) -> date:
    """n-th weekday of a month; n = -1 is the last."""
    if n > 0:
        first = date(year, month, 1)
        return first + timedelta(days=(weekday - first.weekday()) % 7 + 7 * (n - 1))
    last = date(year + month // 12, month % 12 + 1, 1) - timedelta(days=1)
    return last - timedelta(days=(last.weekday() - weekday) % 7)


def easter(year: int) -> date:
    """Gregorian Easter Sunday (anonymous algorithm)."""
    a, (b, c) = year % 19, divmod(year, 100)
    d, e = divmod(b, 4)
    g = (8 * b + 13) // 25
    h = (19 * a + b - d - g + 15) % 30
    i, k = divmod(c, 4)
    lo = (32 + 2 * e + 2 * i - h - k) % 7
    m = (a + 11 * h + 19 * lo) // 433
    month = (h + lo - 7 * m + 90) // 25
    return date(year, month, (h + lo - 7 * m + 33 * month + 19) % 32)


def _observed(d: date) -> date | None:
    """Saturday holidays move to Friday, Sunday ones to Monday; New Year's on a Saturday is not kept."""
    if d.weekday() == 5:
        return None if (d.month, d.day) == (1, 1) else d - timedelta(days=1)
    return d + timedelta(days=1) if d.weekday() == 6 else d


@lru_cache(maxsize=256)
def holidays(year: int) -> frozenset[date]:
    fixed = [date(year, 1, 1), date(year, 7, 4), date(year, 12, 25)] + ([date(year, 6, 19)] if year >= 2022 else [])
    moving = [_nth(year, 1, 0, 3), _nth(year, 2, 0, 3), easter(year) - timedelta(days=2), _nth(year, 5, 0, -1), _nth(year, 9, 0, 1), _nth(year, 11, 3, 4)]
    return frozenset([d for f in fixed if (d := _observed(f))] + moving) | {d for d in AD_HOC if d.year == year}


def is_session(d: date) -> bool:
    return d.weekday() < 5 and d not in holidays(d.year)


def is_half_day(d: date) -> bool:
    """13:00 close: the day after Thanksgiving, Christmas Eve and 3 July where they are sessions."""
    return is_session(d) and (d == _nth(d.year, 11, 3, 4) + timedelta(days=1) or (d.month, d.day) in ((12, 24), (7, 3)))


def close_utc(d: date) -> datetime:
    """Close of a session; ValueError for a day that is none."""
    if not is_session(d):
        raise ValueError(f"{d} is no NYSE session")
    return datetime.combine(d, time(13 if is_half_day(d) else 16), NEW_YORK).astimezone(UTC)


def sessions_between(start: date, end: date) -> list[date]:
    return [d for k in range((end - start).days + 1) if is_session(d := start + timedelta(days=k))]


def session_axis(target: date, n: int = 30, within_days: int = 90) -> list[date]:
    """The last n sessions up to target."""
    return sessions_between(target - timedelta(days=within_days), target)[-n:]


def latest_completed(now: datetime, within_days: int = 14) -> date:
    today = now.astimezone(NEW_YORK).date()
    done = [d for d in sessions_between(today - timedelta(days=within_days), today) if close_utc(d) <= now]
    if not done:
        raise ValueError("no session was completed lately")
    return done[-1]


def sessions_table(spark: SparkSession, start: date, end: date) -> DataFrame:
    """session_date DATE, market_close_utc TIMESTAMP, is_half_day: a dimension of some 250 rows a year."""
    rows = [(d, close_utc(d), is_half_day(d)) for d in sessions_between(start, end)]
    return spark.createDataFrame(rows, "session_date date, market_close_utc timestamp, is_half_day boolean")


def completed_session(session: date | None, now: datetime) -> dict:
    """Whether a session (none: the latest) is over, with the reason."""
    report = {"run": False, "as_of_date": now.astimezone(NEW_YORK).date().isoformat(), "checked_date": None, "trading_date": None, "reason": "requested_completed_nyse_session", "session_market_close_utc": None}
    if session is None:
        session, report["reason"] = latest_completed(now), "latest_completed_nyse_session"
    report["checked_date"] = session.isoformat()
    if not is_session(session):
        return report | {"reason": "requested_date_was_not_trading_session"}
    report |= {"trading_date": session.isoformat(), "session_market_close_utc": close_utc(session).strftime("%Y-%m-%dT%H:%M:%SZ")}
    if close_utc(session) > now:
        return report | {"reason": "requested_session_has_not_closed"}
    return report | {"run": True}


def should_run(as_of: date, force: bool = False, offset_days: int = 0) -> dict:
    """Whether the day offset_days before as_of gets a snapshot."""
    day = as_of - timedelta(days=offset_days)
    run = force or is_session(day)
    reason = "forced" if force else "checked_date_was_trading_day" if run else "checked_date_was_not_trading_day"
    return {"run": run, "as_of_date": as_of.isoformat(), "checked_date": day.isoformat(), "reason": reason, "offset_days": offset_days, "trading_date": day.isoformat() if run else None}


def last_weekday_occurrence(now: datetime, cron: str) -> datetime:
    """Latest New York time at or before now of a cron 'M H * * 1-5'; ValueError for any other cron."""
    parts = re.split(r"\s+", cron.strip())
    if len(parts) != 5 or parts[2:] != ["*", "*", "1-5"] or not all(re.fullmatch(r"\d{1,2}", p) for p in parts[:2]):
        raise ValueError(f"not a weekday schedule: {cron}")
    at = datetime.combine(now.astimezone(NEW_YORK).date(), time(int(parts[1]), int(parts[0])), NEW_YORK)
    while at > now or at.weekday() > 4:
        at -= timedelta(days=1)
    return at.astimezone(UTC)


def schedule_gate(event: str, cron: str | None, now: datetime) -> dict:
    """Whether a scheduled or manual trigger may run, with the reason."""
    out = {"run": False, "event_name": event, "event_schedule": (cron or "").strip(), "new_york_date": now.astimezone(NEW_YORK).date().isoformat(), "reason": "unsupported_event"}
    if event == "workflow_dispatch":
        return out | {"run": True, "reason": "manual_dispatch"}
    if event != "schedule":
        return out
    try:
        at = last_weekday_occurrence(now, cron or "")
    except ValueError:
        return out | {"reason": "unknown_schedule"}
    day = at.astimezone(NEW_YORK).date()
    out |= {"new_york_date": day.isoformat(), "expected_schedule": out["event_schedule"]}
    if not is_session(day):
        return out | {"reason": "new_york_date_was_not_trading_session"}
    if at < close_utc(day):
        return out | {"reason": "schedule_before_session_close"}
    return out | {"run": True, "reason": "authorized_new_york_weekday_schedule"}
