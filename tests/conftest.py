import os
import sys
import tempfile
import zipfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tapeworks import contract as C  # noqa: E402
from tapeworks.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=4,
                      extra={"spark.driver.memory": "4g"})
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tw-test-ckpt-"))
    yield s
    s.stop()


def tick_line(ref="2026-06-30", symbol="ABCD39", action="0", price="55,100", qty="1",
              time="090005990", trade_id="10", session="1", trade_date=None, buyer="90",
              seller="3", channel="2"):
    """One tick TXT line from field values (all text)."""
    return ";".join([ref, symbol, action, price, qty, time, trade_id, session,
                     trade_date if trade_date is not None else ref, buyer, seller, channel])


def tick_text(lines, header=C.EXPECTED_HEADER, newline="\n"):
    body = [header, *lines] if header is not None else list(lines)
    return (newline.join(body) + newline).encode("latin-1")


def write_zip(folder, feed, day, members):
    """Archive named by the feed template holding ``members`` {name: bytes}."""
    y, m, d = day.split("-")
    name = f"{y}{m}{d}_NEGOCIOSAVISTA.zip" if feed == "RV" else f"{d}-{m}-{y}_NEGOCIOSAVISTA_DRV.zip"
    path = os.path.join(folder, name)
    with zipfile.ZipFile(path, "w") as z:
        for member, data in members.items():
            z.writestr(member, data)
    return path


def txt_name(feed, day, suffix=""):
    y, m, d = day.split("-")
    return f"{d}-{m}-{y}_NEGOCIOSAVISTA_{'RV' if feed == 'RV' else 'DRV'}{suffix}.txt"
