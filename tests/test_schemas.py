from undercut import schemas


def test_telemetry_contract():
    assert len(schemas.TELEMETRY.names) == 26
    assert not any(f.nullable for f in schemas.TELEMETRY.fields)
    assert {"car_id", "driver_id", "session_id", "timestamp_ms", "tire_compound"} <= set(schemas.TELEMETRY.names)


def test_enriched_adds_twelve():
    assert len(schemas.ENRICHED.names) == 38
    assert schemas.ENRICHED.names[:26] == schemas.TELEMETRY.names
    assert [f.name for f in schemas.ENRICHED.fields[26:] if not f.nullable] == ["enrichment_ts_ms", "enriched"]


def test_compounds_in_order():
    assert schemas.TIRE_COMPOUNDS == ("SOFT", "MEDIUM", "HARD", "INTER", "WET")


def test_small_contracts():
    assert len(schemas.AGGREGATES.names) == 8
    assert len(schemas.PREDICTION.names) == 5
    assert set(schemas.PRIMARY_KEY) == set(schemas.REFERENCE_TABLES)
