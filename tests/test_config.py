import pytest

from relaykit.config import get_bool, read_properties, settings_from


def test_properties_to_settings():
    props = read_properties("""
# comment
event.tables = pay, user_info
batch.report.size=30
report.mode.pay= batch
report.mode.user_info=single
report.mode.nope=SINGLE
batch.db.size=abc
""")
    s = settings_from(props)
    assert s.tables == ["pay", "user_info"]
    assert s.run.batch_size == 30
    assert s.run.page_size == 1000  # malformed number → default
    assert dict(s.run.mode_overrides) == {"pay": "BATCH", "user_info": "SINGLE"}
    assert s.max_retry_count == 3


def test_ranges_and_unknown_tables():
    with pytest.raises(ValueError):
        settings_from({"batch.report.size": "51"})
    with pytest.raises(ValueError, match="Unknown table name"):
        settings_from({"event.tables": "pay,page_view"})
    assert get_bool({"x": "yes"}, "x") is False and get_bool({"x": "TRUE"}, "x") is True
