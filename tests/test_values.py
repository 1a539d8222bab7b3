import pytest

from skyledger.functions.values import DateError, MarketDate, days_in_month, format_utc, is_canonical_symbol, is_safe_relative_path, is_valid_dataset_id, prefix_for_symbol, sha256_hex
from skyledger.operators.network import EngineError
from skyledger.plans.run import PredictRequest, RequestError, exit_code
from skyledger.sources.files import ArchiveError
from skyledger.sources.predictions import OutputError


def test_dates_round_trip():
    for text in ("2021-05-03", "0000-02-29", "9999-12-31", "2000-02-29"):
        assert str(MarketDate.parse(text)) == text
        assert MarketDate.from_epoch_days(MarketDate.parse(text).epoch_days()) == MarketDate.parse(text)
    assert MarketDate(1970, 1, 2).epoch_days() == 1


@pytest.mark.parametrize("text", ["", "2021-5-31", " 2021-05-31", "2021-05-31\n", "2021/05/31", "2021-05-31T00", "20210531", "２021-05-31", "+021-05-31"])
def test_malformed_dates(text):
    with pytest.raises(DateError, match="must read YYYY-MM-DD") as e:
        MarketDate.parse(text)
    assert e.value.kind == "format"


@pytest.mark.parametrize("text", ["2021-02-29", "1900-02-29", "2021-00-10", "2021-13-01", "2021-04-31", "2021-01-00"])
def test_impossible_days(text):
    with pytest.raises(DateError, match=f"no day {text}") as e:
        MarketDate.parse(text)
    assert e.value.kind == "range"


def test_order_and_months():
    assert MarketDate(2020, 12, 31) < MarketDate(2021, 1, 1) < MarketDate(2021, 1, 2)
    assert [days_in_month(2024, 2), days_in_month(2100, 2), days_in_month(2000, 2), days_in_month(2021, 13), days_in_month(2021, 4)] == [29, 28, 29, 0, 30]


def test_dataset_ids():
    for good in ("a", "-x", "2021.05_a-b", "..a", "x" * 128):
        assert is_valid_dataset_id(good)
    for bad in ("", ".", "..", "a/b", "a b", "a\n", "é", "x" * 129):
        assert not is_valid_dataset_id(bad)


def test_paths():
    for good in ("a.bin", "2021/05/A/0.bin", "a/..b/c"):
        assert is_safe_relative_path(good)
    for bad in ("", "/a", "a//b", "a/", "../a", "a/./b", "a\\b", ".."):
        assert not is_safe_relative_path(bad)


def test_prefixes_symbols_hash_and_time():
    assert [prefix_for_symbol(s) for s in ("AAPL", "bhp", "3M", "^GSPC", "", "Ü", "ı", "ſ", "٣")] == ["A", "B", "3", "_", "_", "_", "_", "_", "_"]
    assert is_canonical_symbol("A B") and not any(map(is_canonical_symbol, ("", " A", "A\t", "A　", " A")))
    assert sha256_hex(b"") == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert [format_utc(s) for s in (0, 951_782_400, 4_107_542_399)] == ["1970-01-01T00:00:00Z", "2000-02-29T00:00:00Z", "2100-02-28T23:59:59Z"]


def test_requests():
    day = MarketDate(2021, 5, 3)
    PredictRequest("c", "a", "o", "ds", day, day).validate()
    for kind, message, request in [
        ("empty_path", "--creature is empty", PredictRequest("", "", "", "?")),
        ("empty_path", "--archive is empty", PredictRequest("c", "", "")),
        ("empty_path", "--output is empty", PredictRequest("c", "a", "")),
        ("date_order", "--from 2021-05-03 is after --to 2021-05-02", PredictRequest("c", "a", "o", "?", day, MarketDate(2021, 5, 2))),
        ("dataset_id", "--dataset '../x' is not a dataset id", PredictRequest("c", "a", "o", "../x")),
    ]:
        with pytest.raises(RequestError) as e:
            request.validate()
        assert e.value.kind == kind and message in str(e.value)


def test_exit_codes_and_messages():
    found = [RequestError("empty_path", ""), ArchiveError("io", "p", "d"), ArchiveError("hash", "p", "d"), EngineError("io", ""), EngineError("creature", ""), OutputError("occupied", "o", "d"), OutputError("io", "o", "d")]
    assert [exit_code(e) for e in found] == [64, 66, 65, 66, 65, 73, 74]
    assert str(found[2]) == "archive hash fault at p: d" and str(found[6]) == "cannot write o: d"
    assert str(found[5]) == "o is taken: d"
