"""Settings are of their kind or an error that names them."""

import pytest

from marketlake.functions.settings import parse_bool, parse_float, parse_int, parse_list


def test_absent_and_blank_values_are_the_default():
    for blank in (None, "", "  "):
        assert parse_bool("x", blank, True) is True
        assert parse_int("x", blank, 7) == 7
        assert parse_float("x", blank, None) is None


def test_values_of_their_kind():
    assert [parse_bool("x", v, False) for v in ("true", " YES ", "1", "off", "0", False)] == [True, True, True, False, False, False]
    assert [parse_int("x", v, 0) for v in ("12", "-3", "+4", 5)] == [12, -3, 4, 5]
    assert [parse_float("x", v, 0.0) for v in ("1.5", "2", "-1e3")] == [1.5, 2.0, -1000.0]
    assert parse_list(" a, b,,a ,c ") == ["a", "b", "c"] and parse_list(None) == []


@pytest.mark.parametrize("call", [
    lambda: parse_bool("speed", "maybe", True), lambda: parse_int("speed", "1.0", 1), lambda: parse_int("speed", "--1", 1),
    lambda: parse_int("speed", "٣", 1), lambda: parse_int("speed", "0", 1, least=1), lambda: parse_float("speed", "nan", 1.0),
    lambda: parse_float("speed", "fast", 1.0), lambda: parse_float("speed", "-1", 1.0, least=0.0)])
def test_anything_else_is_an_error_that_names_the_setting(call):
    with pytest.raises(ValueError, match="speed"):
        call()
