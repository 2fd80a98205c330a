"""Staging, dimensions, facts and reports on hand-written rows (FIXTURES §3)."""

import datetime as dt

import pytest

from chanwh import schemas as S
from chanwh.plans import models as M
from chanwh.plans import reports as R
from tests.conftest import rows

T = dt.datetime


def raw(spark, data):
    full = []
    for d in data:
        base = dict(message_id=None, channel_name=None, message_date=None, message_text=None, has_media=None,
                    image_path=None, views=None, forwards=None, is_reply=None, reply_to_msg_id=None,
                    scraped_at=None, loaded_at=None)
        base.update(d)
        full.append(tuple(base[f.name] for f in S.RAW_MESSAGES.fields))
    return spark.createDataFrame(full, S.RAW_MESSAGES)


def test_stg_messages_filters(spark):
    r = raw(spark, [
        dict(message_id=1, channel_name="A", message_date=T(2024, 1, 1), message_text="\t"),     # tab is not blank
        dict(message_id=2, channel_name="   ", message_date=T(2024, 1, 1), message_text="hi"),  # blank channel kept
        dict(message_id=3, channel_name="A", message_date=T(2024, 1, 1), message_text="   "),   # blank text dropped
        dict(message_id=4, channel_name="A", message_date=None, message_text="x"),              # NULL date dropped
        dict(message_id=5, channel_name="A", message_date=T(2024, 1, 1), message_text="x", image_path=""),
        dict(message_id=6, channel_name=" B ", message_date=T(2024, 1, 1, 23), message_text="y",
             image_path="p.jpg", views=7),
    ])
    got = rows(M.stg_messages(r), "message_id", "channel_name", "has_image", "view_count", "message_length")
    assert got == [(1, "A", False, 0, 1), (2, "", False, 0, 2), (5, "A", False, 0, 1), (6, "B", True, 7, 1)]


def test_stg_detections_blank_channel_dropped(spark):
    d = spark.createDataFrame([(1, "  ", None, None, None, None, "x", None, None),
                               (2, "C", None, None, None, None, " Promotional ", None, None)], S.RAW_DETECTIONS)
    got = rows(M.stg_detections(d), "message_id", "image_category", "total_detections", "max_confidence")
    assert [g[:3] for g in got] == [(2, "promotional", 0)]
    assert float(got[0][3]) == 0.0


def test_dim_dates_span_and_names(spark):
    r = raw(spark, [dict(message_id=1, channel_name="A", message_date=T(2024, 2, 28), message_text="a"),
                    dict(message_id=2, channel_name="A", message_date=T(2024, 3, 1), message_text="a")])
    dd = M.dim_dates(M.stg_messages(r))
    assert [r[0] for r in dd.orderBy("date_key").select("date_key").collect()] == [20240228, 20240229, 20240301]
    r2 = raw(spark, [dict(message_id=1, channel_name="A", message_date=T(2023, 1, 1), message_text="a")])
    row = M.dim_dates(M.stg_messages(r2)).first()
    assert (row.day_of_week, row.week_of_year, row.day_name, row.month_name, row.is_weekend) == \
        (0, 52, "Sunday   ", "January  ", True)
    empty = raw(spark, [dict(message_id=1, channel_name="A", message_date=T(2023, 1, 1), message_text=" ")])
    assert M.dim_dates(M.stg_messages(empty)).count() == 0


def test_dim_channels(spark):
    r = raw(spark, [dict(message_id=i, channel_name="Tikvah | Pharma", message_date=T(2024, 1, i), message_text="a",
                         views=v, image_path="p" if i == 1 else None) for i, v in [(1, 1), (2, 2), (3, 2)]])
    row = M.dim_channels(M.stg_messages(r)).first()
    assert row.channel_type == "Pharmaceutical"
    assert str(row.avg_views) == "1.67" and row.image_percentage == 33.33 and row.total_posts == 3


@pytest.fixture()
def wh(spark):
    r = raw(spark, [
        dict(message_id=1, channel_name="CheMed", message_date=T(2024, 1, 1), message_text="aspirin tablets aspirin",
             views=10, forwards=1),
        dict(message_id=2, channel_name="CheMed", message_date=T(2024, 1, 5), message_text="Aspirin 50% off",
             views=20),
        dict(message_id=3, channel_name="Other", message_date=T(2024, 1, 5), message_text="axb 500 tablets"),
    ])
    return M.warehouse(r)


def test_channel_activity(spark, wh):
    tot = R.channel_totals(wh.fct_messages, wh.dim_channels, "CheMed").first()
    assert (tot.total_messages, tot.total_views, tot.avg_views, tot.total_forwards) == (2, 30, 15.0, 1)
    daily = R.channel_daily(wh.fct_messages, wh.dim_channels, wh.dim_dates, "CheMed", 3, "2024-01-06")
    assert [tuple(r) for r in daily.collect()] == [(dt.date(2024, 1, 5), 1, 20, 20.0, 0)]
    env = R.channel_activity_envelope(wh.fct_messages, wh.dim_channels, wh.dim_dates, "CheMed", 1, "2024-03-01").first()
    assert env.total_messages == 2 and env.daily_activity == []
    with pytest.raises(R.ChannelNotFound):
        R.channel_totals(wh.fct_messages, wh.dim_channels, "Nope")
    args = (wh.fct_messages, wh.dim_channels, wh.dim_dates, "Nope", 1, "2024-03-01")
    with pytest.raises(R.ChannelNotFound):
        R.channel_activity_envelope(*args)
    late = R.channel_activity_envelope(*args, check=False)                # no job yet
    with pytest.raises(Exception, match="ChannelNotFound: Nope"):
        late.collect()
    assert R.channel_daily(*args, check=False).count() == 0


def test_top_terms(spark, wh):
    got = [tuple(r) for r in R.top_terms(wh.fct_messages, 10, 4).collect()]
    # "aspirin" ×3, "tablets" ×2 counted; "500" all digits; "off" too short; "axb" too short
    assert got == [("aspirin", 3, 60.0), ("tablets", 2, 40.0)]
    assert R.top_terms_total(wh.fct_messages, 4).first().total_terms == 2   # "50%" is too short
    with pytest.raises(ValueError):
        R.top_terms(wh.fct_messages, 0)


def test_search(spark, wh):
    got = R.search_messages(wh.fct_messages, wh.dim_channels, "a_b").collect()
    assert [r.message_id for r in got] == [3] and got[0].relevance_score == 1.0
    assert R.search_count(wh.fct_messages, wh.dim_channels, "50\\%").first().total_found == 1
    assert R.search_count(wh.fct_messages, wh.dim_channels, "aspirin", channel="Other").first().total_found == 0
    with pytest.raises(ValueError):
        R.search_messages(wh.fct_messages, wh.dim_channels, "a")
