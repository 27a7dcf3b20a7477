"""Objects are loaded once; unfinished loads are neither read nor lost."""

import datetime as dt

from tallow.operators.load import to_bronze
from tallow.sources.events import binance_messages, read_events
from tallow.sources.landing import write_landing
from tallow.sources.ledger import landed_objects, load_new, new_objects, read_ledger, read_loaded
from tallow.sources.messages import envelope_binance

from conftest import SF_SMALL


def envelopes(spark, day):
    ev = read_events(spark, SF_SMALL).where(f"date(ts) = '2024-01-{day:02d}'")
    return envelope_binance(binance_messages(ev)).coalesce(1)


def test_every_object_is_loaded_once(spark, scratch):
    root, ledger, out = (f"{scratch}/{n}" for n in ("landing", "ledger", "bronze"))
    assert load_new(spark, root + "x", ledger, out, to_bronze, hours=[dt.datetime(2024, 1, 3)])["objects"] == 0
    write_landing(envelopes(spark, 3), root)
    first = load_new(spark, root, ledger, out, to_bronze)
    assert first["objects"] == landed_objects(spark, root).count() > 0
    assert load_new(spark, root, ledger, out, to_bronze) == {"load_id": None, "objects": 0}
    write_landing(envelopes(spark, 4), root)
    assert new_objects(landed_objects(spark, root), read_ledger(spark, ledger)).where("path NOT LIKE '%day=04%'").count() == 0

    # a load that stops before its commit leaves rows that nobody reads and objects that are still new
    new = new_objects(landed_objects(spark, root), read_ledger(spark, ledger)).count()
    to_bronze(envelopes(spark, 4)).write.parquet(f"{out}/load_id=lost")
    third = load_new(spark, root, ledger, out, to_bronze)
    assert third["objects"] == new
    both = to_bronze(envelopes(spark, 3)).unionByName(to_bronze(envelopes(spark, 4)))
    loaded = read_loaded(spark, ledger, out)
    assert loaded.count() == both.count() and loaded.exceptAll(both).count() == 0


def test_hours_limit_the_listing_and_a_replaced_object_is_new(spark, scratch):
    root, ledger, out = (f"{scratch}/{n}" for n in ("landing", "ledger", "bronze"))
    assert read_loaded(spark, ledger, out).count() == 0
    write_landing(envelopes(spark, 5), root)
    hours = sorted({r[0] for r in envelopes(spark, 5).selectExpr("date_trunc('hour', event_ts)").collect()})
    one = landed_objects(spark, root, hours[:1])
    assert 0 < one.count() < landed_objects(spark, root).count()
    assert load_new(spark, root, ledger, out, to_bronze, hours=hours[:1])["objects"] == one.count()
    rewritten = one.selectExpr("path", "length + 1 AS length", "modified")
    assert new_objects(rewritten, read_ledger(spark, ledger)).count() == one.count()
