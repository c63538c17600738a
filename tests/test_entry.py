import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    n = df.count()
    assert n > 0
    assert df.columns == ["trip_id", "vehicle_number", "line", "brigade", "stop_id", "stop_name", "actual_time",
                          "scheduled_arrival", "meters_to_stop", "delay_seconds", "delay_minutes"]


def test_contract_shapes():
    q, o = E.queries(), E.oracle_sql()
    assert len(q) >= 80
    assert all(callable(f) for f in q.values())
    assert all(isinstance(s, str) and s.strip() for s in o.values())
