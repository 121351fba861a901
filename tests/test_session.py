"""Tables that cut the lineage."""

from pathweave import session


def test_tables_collect_the_driver(spark, monkeypatch):
    """Every so many tables the driver's memory is collected, and the tables stay whole."""
    collections = lambda: sum(b.getCollectionCount() for b in spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans())
    calls, real = [], session.collect_driver
    monkeypatch.setattr(session, "collect_driver", lambda s: calls.append(real(s)))
    before = collections()
    tables = [session.cut(spark.range(i)) for i in range(2 * session.COLLECT)]
    assert len(calls) == 2 and collections() >= before + 2
    assert [t.count() for t in tables] == list(range(2 * session.COLLECT))
    session.forget(*tables)
