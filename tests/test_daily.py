"""The daily job end to end on small hand-written inputs."""
import json
import os
import tempfile

from pyspark.sql import functions as F

import pytest

from layerflow.operators.relational import ConstraintViolation
from layerflow.plans import daily
from layerflow.sources.layers import LayerStore, LoadGuardError

NO_FLOORS = {}


def _review(i, **kw):
    d = {"id": f"r{i}", "accommodationId": 5000 + i % 3, "bookingId": i, "createdAt": "2024-03-01 10:00:00",
         "arrivalDate": "2024-03-01", "departureDate": "2024-03-04", "globalValoration": 8.5,
         "saleschannelCode": "AIRBNB" if i % 2 else "BOOKING", "language": "pt", "validated": True,
         "neutralComment": "ok", "response": "Obrigado" if i % 2 else None,
         "evaluationAspects": [{"evaluationAspect": {"type": "CLEANLINESS"}, "valoration": 9.0},
                               {"evaluationAspect": {"type": "LOCATION"}, "valoration": 7.0},
                               {"evaluationAspect": {"type": "CLEANLINESS"}, "valoration": 9.0}]}
    d.update(kw)
    return d


def test_daily_run(spark):
    root = tempfile.mkdtemp()
    pages = os.path.join(root, "pages")
    os.makedirs(pages)
    p1 = {"data": [_review(i) for i in range(6)] + ["junk"], "_links": {"next": "page-2"}}
    p2 = {"data": [_review(1, globalValoration=6.0, response=None)]}
    for n, p in ((1, p1), (2, p2)):
        with open(os.path.join(pages, f"page-{n:04d}.json"), "w") as f:
            json.dump(p, f, indent=2)   # pretty-printed, as an API returns it
    with open(os.path.join(pages, "page-0003.json"), "w") as f:
        f.write('{"data": "not a list"}')
    with open(os.path.join(root, "Propriedades.csv"), "w", encoding="utf-8") as f:
        f.write("﻿ID,Equipa,Bairro,WC CodPostal,WC ZonaPostal,CoordsGPS,Inativo,Data Inicio,Data Inativo,"
                "Andar,Elevador,Máx.Ocupação,NumWCDuche,NumWCBasico,Lugar Garagem,RCM MaqRoupa,RCM MaqLoica,"
                "RCM ArCond,AutoCheckin\n")
        f.write('1,North,Alfama,1100-123,,"38.71, -9.13",0,2020-01-01,,3°,1,4,1,0,,1,,1,0\n')
        f.write("2,South,Belém,1400,045,bad,1,2019-05-01,2023-01-01,rc esq,0,6.0,2,1,P1,0,1,0,NA\n")
    with open(os.path.join(root, "mapping.csv"), "w") as f:
        f.write("Internal Id,External Id\n1,5000\n2,5001\n")
    res = daily.run(spark, pages, os.path.join(root, "Propriedades.csv"), os.path.join(root, "mapping.csv"),
                    os.path.join(root, "store"), as_of="2026-01-01 00:00:00", loaded_at="2024-06-01 00:00:00")
    m = res.model
    rev = {r.review_id: r for r in m.rel["reviews"].collect()}
    assert len(rev) == 6
    assert rev["r1"].overall_score == 6.0 and rev["r1"].response_text is None     # later page, explicit null
    assert rev["r3"].response_text == "Obrigado"
    asp = m.rel["review_aspects"].where(F.col("review_id") == "r0").orderBy("aspect_id").collect()
    assert [(a.aspect, a.score) for a in asp] == [("CLEANLINESS", 9.0), ("LOCATION", 7.0)]
    props = {r.property_id: r for r in m.rel["properties"].collect()}
    assert (props[1].postcode_prefix, props[1].postcode_suffix, props[1].floor) == (1100, 123, "3º")
    assert (props[1].latitude, props[1].longitude) == (38.71, -9.13)
    assert (props[2].postcode_prefix, props[2].postcode_suffix, props[2].floor) == (1400, 45, "R/C esq")
    assert props[2].max_occupancy == 6 and props[2].has_self_checkin == 0
    report = {r.check_id: r for r in res.report.collect()}
    assert len(report) == 44 and res.failed            # fewer than 100 reviews: V2 fails
    assert all(r.status == "PASS" for r in report.values() if r.family in ("V1", "V3", "V4", "V8", "V9"))
    facts = {r.review_id: r for r in res.star["fact_reviews"].collect()}
    assert facts["r0"].property_key == 1 and facts["r1"].property_key == 2 and facts["r2"].property_key == -1
    assert facts["r0"].stay_nights == 3
    bad = res.model.store.table("ingest", "bad_payloads").collect()
    assert [b.reason for b in bad] == ["data_not_list"]
    assert res.model.store.table("docs", "fields__quarantine").count() == 1
    assert tuple(res.model.store.table("ingest", "shred_counts").first()) == (6, 0, 0)
    filled = {r.column_name: r.filled for r in res.model.store.table("ingest", "filled_flags").collect()}
    assert filled == {"is_inactive": 0, "has_washing_machine": 0, "has_dishwasher": 1, "has_air_conditioning": 0, "has_self_checkin": 1}


def test_daily_second_run_merges_new_pages(spark):
    root = tempfile.mkdtemp()
    pages = os.path.join(root, "pages")
    os.makedirs(pages)
    with open(os.path.join(pages, "page-0001.json"), "w") as f:
        json.dump({"data": [_review(i) for i in range(4)]}, f)
    with open(os.path.join(root, "p.csv"), "w") as f:
        f.write("ID,Equipa\n1,North\n")
    with open(os.path.join(root, "m.csv"), "w") as f:
        f.write("Internal Id,External Id\n1,5000\n")
    args = (os.path.join(root, "p.csv"), os.path.join(root, "m.csv"), os.path.join(root, "store"))
    first = daily.run(spark, pages, *args, as_of="2026-01-01 00:00:00", build_star=False)
    assert first.model.rel["reviews"].count() == 4
    # the next day: one review changes, one arrives with odd shapes
    with open(os.path.join(pages, "page-0002.json"), "w") as f:
        json.dump({"data": [_review(2, globalValoration=3.5, evaluationAspects=[]),
                            _review(9, accommodationId="5001", createdAt="2024-03-01T10:00:00+02:00",
                                    **{"Guest Country": "PT"})]}, f)
    second = daily.run(spark, pages, *args, as_of="2026-01-01 00:00:00", build_star=False)
    m = second.model.store.table("ingest", "upsert_metrics").first()
    # both pages are re-read: r0-r3 unchanged but matched, r2 modified, r9 new
    assert (m.upserted, m.matched, m.modified, m.total) == (1, 4, 1, 5)
    rev = {r.review_id: r for r in second.model.rel["reviews"].collect()}
    assert len(rev) == 5 and rev["r2"].overall_score == 3.5
    assert rev["r9"].external_property_id == 5001 and rev["r9"].guest_country == "PT"
    assert str(rev["r9"].created_at) == "2024-03-01 08:00:00"
    # an emptied list removes the review's aspects
    assert second.model.rel["review_aspects"].where(F.col("review_id") == "r2").count() == 0
    assert second.model.rel["review_aspects"].where(F.col("review_id") == "r1").count() == 2


def test_daily_cli_minimal_inputs(spark):
    root = tempfile.mkdtemp()
    os.makedirs(os.path.join(root, "pages"))
    docs = [{"id": f"r{i}", "accommodationId": 5000, "createdAt": "2024-03-01 10:00:00",
             "evaluationAspects": [{"evaluationAspect": {"type": "VALUE"}, "valoration": 8.0}]} for i in range(3)]
    with open(os.path.join(root, "pages", "page-0001.json"), "w") as f:
        json.dump({"data": docs}, f, indent=2)
    with open(os.path.join(root, "p.csv"), "w") as f:
        f.write("ID,Equipa\n1,North\n")
    with open(os.path.join(root, "m.csv"), "w") as f:
        f.write("Internal Id,External Id\n1,5000\n")
    code = daily.main(["--pages", os.path.join(root, "pages"), "--properties", os.path.join(root, "p.csv"),
                       "--mapping", os.path.join(root, "m.csv"), "--root", os.path.join(root, "store")])
    assert code == 1          # three reviews are below the minimum-row checks


def test_daily_without_aspect_lists(spark):
    root = tempfile.mkdtemp()
    os.makedirs(os.path.join(root, "pages"))
    with open(os.path.join(root, "pages", "page-0001.json"), "w") as f:
        json.dump({"data": [{"id": "r1", "accommodationId": 5000, "globalValoration": 9.0}]}, f)
    with open(os.path.join(root, "p.csv"), "w") as f:
        f.write("ID\n1\n")
    with open(os.path.join(root, "m.csv"), "w") as f:
        f.write("Internal Id,External Id\n1,5000\n")
    res = daily.run(spark, os.path.join(root, "pages"), os.path.join(root, "p.csv"), os.path.join(root, "m.csv"),
                    os.path.join(root, "store"), as_of="2026-01-01 00:00:00", floors=NO_FLOORS)
    assert res.model.rel["reviews"].count() == 1 and res.model.rel["review_aspects"].count() == 0
    assert res.star["fact_reviews"].first().property_key == 1


def _inputs(root, data):
    os.makedirs(os.path.join(root, "pages"), exist_ok=True)
    with open(os.path.join(root, "pages", "page-0001.json"), "w") as f:
        json.dump({"data": data}, f)
    with open(os.path.join(root, "p.csv"), "w") as f:
        f.write("ID\n1\n")
    with open(os.path.join(root, "m.csv"), "w") as f:
        f.write("Internal Id,External Id\n1,5000\n")
    return (os.path.join(root, "pages"), os.path.join(root, "p.csv"), os.path.join(root, "m.csv"),
            os.path.join(root, "store"))


def test_daily_numeric_ids_and_repeats_on_a_page(spark):
    root = tempfile.mkdtemp()
    args = _inputs(root, [{"id": 7, "globalValoration": 5.0}, {"id": 8, "globalValoration": 6.0},
                          {"id": 7, "globalValoration": 9.5}])
    res = daily.run(spark, *args, as_of="2026-01-01 00:00:00", build_star=False, floors=NO_FLOORS)
    rev = {r.review_id: r.overall_score for r in res.model.rel["reviews"].collect()}
    assert rev == {"7": 9.5, "8": 6.0}                # later position on the page wins


def test_daily_name_collision_publishes_nothing(spark):
    import pytest
    root = tempfile.mkdtemp()
    args = _inputs(root, [{"id": "a", "Guest Name": "x"}, {"id": "b", "guest_name": "y"}])
    with pytest.raises(ValueError):
        daily.run(spark, *args, as_of="2026-01-01 00:00:00", build_star=False)
    from layerflow.sources.layers import LayerStore
    assert LayerStore(spark, args[3]).current("rel")["tables"] == {}


def test_daily_keep_versions(spark):
    root = tempfile.mkdtemp()
    args = _inputs(root, [{"id": "a", "globalValoration": 5.0}])
    daily.run(spark, *args, as_of="2026-01-01 00:00:00", build_star=False, floors=NO_FLOORS)
    with open(os.path.join(args[0], "page-0002.json"), "w") as f:
        json.dump({"data": [{"id": "b", "globalValoration": 7.0}]}, f)
    res = daily.run(spark, *args, as_of="2026-01-01 00:00:00", build_star=False, keep_versions=1, keep_seconds=0,
                    floors=NO_FLOORS)
    from layerflow.sources.layers import LayerStore
    store = LayerStore(spark, args[3])
    assert store.table("docs", "fields").select("id").distinct().count() == 2
    for t in ("reviews", "review_aspects", "properties"):
        vdirs = os.listdir(os.path.join(args[3], "rel", t))
        assert len(vdirs) == 1, (t, vdirs)             # superseded versions dropped
    assert store.table("rel", "reviews").count() == 2
    assert store.table("docs", "fields").select("id").distinct().count() == 2
    assert res.report.count() == 44


LAYERS = ("docs", "ingest", "raw", "clean", "rel", "checks", "star")


def _manifests(spark, root):
    return {layer: LayerStore(spark, root).current(layer)["seq"] for layer in LAYERS}


def test_failed_runs_leave_every_layer(spark):
    root = tempfile.mkdtemp()
    args = _inputs(root, [_review(i) for i in range(3)])
    daily.run(spark, *args, as_of="2026-01-01 00:00:00", build_star=False)
    before = _manifests(spark, args[3])
    assert before["rel"] == 1 and before["docs"] == 1
    with open(args[1], "w") as f:                 # a repeated property key
        f.write("ID\n1\n1\n")
    with open(os.path.join(args[0], "page-0002.json"), "w") as f:
        json.dump({"data": [_review(8)]}, f)
    with pytest.raises(ConstraintViolation):
        daily.run(spark, *args, as_of="2026-01-01 00:00:00", build_star=False)
    assert _manifests(spark, args[3]) == before
    with open(args[1], "w") as f:
        f.write("ID\n1\n")
    with pytest.raises(LoadGuardError):           # fewer rows than the floor
        daily.run(spark, *args, as_of="2026-01-01 00:00:00", build_star=False, floors={"reviews": 100})
    assert _manifests(spark, args[3]) == before


def test_empty_feed_refused_and_empty_csv_keeps_the_table(spark):
    root = tempfile.mkdtemp()
    args = _inputs(root, [])
    with pytest.raises(LoadGuardError):
        daily.run(spark, *args, as_of="2026-01-01 00:00:00", build_star=False)
    assert set(_manifests(spark, args[3]).values()) == {0}
    args = _inputs(root, [_review(i) for i in range(2)])
    daily.run(spark, *args, as_of="2026-01-01 00:00:00", build_star=False)
    with open(args[1], "w") as f:
        f.write("ID\n")
    res = daily.run(spark, *args, as_of="2026-01-01 00:00:00", build_star=False)
    assert [r.id for r in res.model.raw["propriedades"].collect()] == ["1"]
    assert res.model.rel["properties"].count() == 1


def test_later_run_wins_whatever_its_page_numbers(spark):
    root = tempfile.mkdtemp()
    args = _inputs(root, [])
    os.remove(os.path.join(args[0], "page-0001.json"))
    with open(os.path.join(args[0], "page-0007.json"), "w") as f:
        json.dump({"data": [_review(1, title="old")]}, f)
    daily.run(spark, *args, as_of="2026-01-01 00:00:00", build_star=False)
    os.remove(os.path.join(args[0], "page-0007.json"))
    with open(os.path.join(args[0], "page-0001.json"), "w") as f:
        json.dump({"data": [_review(1, title="NEW")]}, f)
    res = daily.run(spark, *args, as_of="2026-01-01 00:00:00", build_star=False, mapping_columns=("internal_id", "external_id"))
    assert [r.review_title for r in res.model.rel["reviews"].collect()] == ["NEW"]


def test_dead_letter_of_all_tables_and_csv_rejects(spark):
    root = tempfile.mkdtemp()
    args = _inputs(root, [_review(1), _review(2, bookingId="12.5"), _review(3, bookingId="inf")])
    with open(args[1], "w") as f:
        f.write("ID,Equipa\n1,a\n3000000000,b\n2.5,c\n4,d,surplus\n")
    with open(args[2], "w") as f:
        f.write("Internal Id,External Id\n1,5000\n2,abc\n")
    res = daily.run(spark, *args, as_of="2026-01-01 00:00:00", build_star=False)
    got = {(r.table_name, r.key, r.error) for r in res.model.dead_letter.collect()}
    assert got == {("properties", "2.5", "fractional value in property_id"), ("property_id_mapping", "2", "not a number in external_property_id"),
                   ("reviews", "r2", "fractional value in booking_id"), ("reviews", "r3", "infinite value in booking_id"),
                   *(("review_aspects", str(i), "its review is in the dead letter") for i in (3, 4, 5, 6))}
    assert {r.review_id for r in res.model.rel["review_aspects"].collect()} == {"r1"}
    assert sorted(r.property_id for r in res.model.rel["properties"].collect()) == [1, 3000000000]   # ids are BIGINT
    rejects = res.model.store.table("ingest", "csv_rejects").collect()
    assert [(r.table_name, json.loads(r.record)) for r in rejects] == [("propriedades", ["4", "d", "surplus"])]
