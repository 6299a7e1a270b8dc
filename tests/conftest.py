import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from candlewick.session import get_session
    return get_session("local[4]", "candlewick-tests", **{"spark.sql.shuffle.partitions": "8"})


@pytest.fixture
def fresh_dir():
    """A new scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="candlewick-test-")


# Fixed value: the documented sample message.
SAMPLE = ('{"e":"kline","E":1752397290016,"s":"BNBBTC","k":{"t":1752397260000,"T":1752397319999,"s":"BNBBTC",'
          '"i":"1m","f":273280640,"L":273280663,"o":"0.00585100","c":"0.00585000","h":"0.00585100",'
          '"l":"0.00584900","v":"5.68800000","n":24,"x":false,"q":"0.03327391","V":"1.25900000",'
          '"Q":"0.00736515","B":"0"}}')
CONTROL = '{"result":null,"id":1}'


def kline_message(symbol: str, close_ms: int, close: float, event_ms: int | None = None,
                  interval_ms: int = 60_000, first: int = 1) -> str:
    """A minimal well-formed kline message for tests."""
    open_ms = close_ms - interval_ms + 1
    e = event_ms if event_ms is not None else close_ms
    return ('{"e":"kline","E":%d,"s":"%s","k":{"t":%d,"T":%d,"s":"%s","i":"1m","f":%d,"L":%d,'
            '"o":"%.8f","c":"%.8f","h":"%.8f","l":"%.8f","v":"1.0","n":1,"x":false,'
            '"q":"1.0","V":"1.0","Q":"1.0","B":"0"}}') % (
        e, symbol, open_ms, close_ms, symbol, first, first, close, close, close, close)
