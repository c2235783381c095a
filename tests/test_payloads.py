
import json

from searchlens import registry as R
from searchlens.plans import association as assoc
from searchlens.plans import heat

from .conftest import SF_SMALL


def test_hot_payload_matches_rankings(spark):
    msg = R.q_hot_payload(spark, SF_SMALL).collect()
    assert len(msg) == 1 and msg[0]["topic"]
    doc = json.loads(msg[0]["value"])
    by_type = R.q_hot_by_type(spark, SF_SMALL).collect()
    total = R.q_hot_total(spark, SF_SMALL).collect()
    assert list(doc)[-1] == "total" and list(doc)[:-1] == sorted({r["content_type"] for r in by_type})
    for t, items in doc.items():
        want = sorted((r for r in (total if t == "total" else by_type) if t == "total" or r["content_type"] == t),
                      key=lambda r: r["rank"])
        assert [e["sid"] for e in items] == [r["sid"] for r in want]
        assert [e["searchCode"] for e in items] == [r["search_code"] for r in want]
        assert [e["contentType"] for e in items] == [r["content_type"] for r in want]


def test_assoc_payload_lists_sids_in_rank_order(spark):
    doc = json.loads(R.q_assoc_payload(spark, SF_SMALL).first()["value"])
    top = R.q_assoc_top_videos(spark, SF_SMALL).collect()
    for t, sids in doc.items():
        assert sids == [r["sid"] for r in sorted((r for r in top if r["content_type"] == t), key=lambda r: r["rank"])]


def test_pref_payload_round_trip(spark):
    msgs = R.q_pref_payload(spark, SF_SMALL).collect()
    prof = R.q_preference_profile(spark, SF_SMALL).collect()
    want = {}
    for r in prof:
        want.setdefault((r["user_id"], r["account_id"]), {}).setdefault(r["band"], []).append(r)
    assert len(msgs) == len(want)
    for m in msgs:
        doc = json.loads(m["value"])
        key = (doc.get("userId"), doc["accountId"])
        bands = want[key]
        assert set(doc) - {"userId", "accountId"} == set(bands)
        for band, items in bands.items():
            ranked = sorted(items, key=lambda r: r["position"])
            assert [(e["contentType"], round(e["score"], 9)) for e in doc[band]] == \
                [(r["content_type"], round(r["score"], 9)) for r in ranked]


def test_heat_and_voice_payloads(spark):
    scores = {r["sid"]: r["score"] for r in R.q_heat_score(spark, SF_SMALL).collect()}
    for m in R.heat_messages(spark, SF_SMALL).collect():
        doc = json.loads(m["value"])
        assert doc["type"] == "vv" and round(doc["score"], 6) == scores[doc["sid"]] and m["key"] == doc["sid"]
    voice = {r["sid"]: r for r in R.q_voice_scores(spark, SF_SMALL).collect()}
    msgs = R.voice_messages(spark, SF_SMALL).collect()
    assert len(msgs) == len(voice)
    for m in msgs:
        doc = json.loads(m["value"])
        assert round(doc["score"], 6) == voice[doc["sid"]]["score"] and doc["contentType"] == voice[doc["sid"]]["content_type"]


def test_editorial_payload(spark):
    doc = json.loads(R.q_editorial_payload(spark, SF_SMALL).first()["value"])
    sample = R.q_editorial_sample(spark, SF_SMALL).collect()
    total = R.q_editorial_sample_total(spark, SF_SMALL).collect()
    assert [e["sid"] for e in doc["total"]] == [r["sid"] for r in sorted(total, key=lambda r: r["rank"])]
    for t in {r["content_type"] for r in sample}:
        assert len(doc[t]) == len([r for r in sample if r["content_type"] == t])


def test_null_fields_left_out(spark):
    df = spark.createDataFrame([("s1", None, "tv", 1.5)], "sid string, title string, content_type string, score double")
    doc = json.loads(heat.voice_payload(df).first()["value"])
    assert doc == {"sid": "s1", "contentType": "tv", "score": 1.5}


def test_top_videos_by_id_payload_holds_numbers(spark):
    top = R.q_assoc_top_videos_by_id(spark, SF_SMALL)
    doc = json.loads(assoc.top_videos_payload(top, key="id").first()["value"])
    assert all(isinstance(x, int) for v in doc.values() for x in v)
