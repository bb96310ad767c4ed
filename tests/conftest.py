import glob
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from surveypulse.session import local_session  # noqa: E402

# Two real event logs, where the variable names them.
REAL_LOGS = sorted(glob.glob(os.environ.get("REAL_LOGS", "")))

MAG_HEADER = "  Xpr       Time     Mag1   Ralt  Roll   Bin"
MAG_ROWS = [
    "    1 143433.600 49000.50  1.200   ###    ff",
    "    2 143433.700 ########  1.300   ###    #####",
    "    3 143433.800 49001.50  1.0d    ###    0a",
    "",
    "    4 143433.900 49002.00   nan    ###    0b",
]

CONFIG = """<?xml version="1.0"?>
<Root>
  <Object Tag="COMPNAME"><Value> CMP_0043 </Value></Object>
  <Object Tag="COM3STATE"><Value>On</Value>
    <Object Tag="BAUD"><Value>115200</Value></Object>
    <Object Tag="BAUD"><Value>9600</Value></Object>
    <Object Tag="MACRO"><Value>GEMK1</Value>
      <Object Tag="LOGLEVEL"><Value>3</Value></Object>
    </Object>
  </Object>
  <Object Tag="NAVNAME"><Value/></Object>
  <Object Tag="NOVALUE"></Object>
  <Object><Value>untagged</Value></Object>
  <Object Tag="COM4STATE"><Value>Off</Value><Object Tag="MACRO"><Value>?</Value></Object>
    <Object Tag="MACRO"><Value>GEMK2</Value></Object></Object>
  <Object Tag="PORTNUM"><Value>1</Value><Value>9</Value></Object>
  <Group><Object Tag="PORTNUM"><Value>2</Value></Object></Group>
  <Object Tag="COM5STATE"/>
</Root>
"""

LOG = """Log file D:\\Events\\EVT{n}.txt opened at Date:20260324 Time:{clock}
14:34:33.6: starting
14:34:42.8:    COM3: Macro GEMK1 OK - 115200
14:34:42.8:    COM4: Macro GEMK2 OK - 115200
14:34:42.8:    COM5: Macro GDRAlt OK - 57600
14:34:42.8:    COM6: Macro GD485 OK - 57600
14:34:42.8:    COM7: Macro XSENS OK - 57600
14:34:42.8:    COM10: Macro GDLas OK - 57600
14:34:49.4: Character Rate on COM3 is 130.8 chars/second
14:34:49.4: Character Rate on COM5 is 0.0 chars/second
14:34:49.4: Character Rate on COM6 is 0.0 chars/second
14:34:49.4: Character Rate on COM7 is 599.3 chars/second
14:34:49.4: Character Rate on COM9 is 5 chars/second
14:34:49.4: Character Rate on COM10 is 1. chars/second
14:34:50.0: Health Warning: M1 TimeO| Health Warning: M2 TimeO|
25:00:00.0: Health Warning: M1 TimeO|
no stamp here !!!!
14:40:00.0: done
"""


@pytest.fixture(scope="session")
def spark():
    return local_session(8)


PORT_NAMES = {"COM3": "GEMK1", "COM4": "GEMK2", "COM5": "GDRAlt", "COM6": "GD485", "COM7": "XSENS", "COM8": "GDGPS",
              "COM9": "GDSpec", "COM10": "GDLas"}
ROUTES = ["COM7", "COM5", "COM10", "COM4", "COM3", "COM6"]


def event_log(number, start, end, alarm, rates, warned, total):
    """An event log with the counts and traps of a real one: warnings in a fixed order, a second stamp
    inside a line, a warning without its closing bar, a name that only begins like a known one."""
    at = f"{start}: "
    out = [f"Log D:\\Events\\EVT0000{number}.txt opened at Date:20260324 Time:{start[:5]}", at + "starting"]
    out += [f"{at}   {p}: Macro {s} OK - 115200/None/8/One-None//" for p, s in PORT_NAMES.items()]
    out += [f"{at}Character Rate on {p} is {r} chars/second" for p, r in zip(PORT_NAMES, rates)]
    out += [f"{at}   M1 latches port {p} runs macro {PORT_NAMES[p]}" for p in ROUTES]
    out += [f"{at}   M2 latches port COM9 runs macro GDSpec", f"{at}   M3 latches port COM8 runs macro GDGPS"]
    out += [f"{at}File: D:\\Data\\{k}0000{number}.txt opened" for k in ("GGA", "MAG", "SPC")]
    out += [f"{alarm}: Mux Timeout > 90% of clock!!!!!!!"]
    common, third, odd = warned
    for i in range(common):
        out += [f"{alarm}: Health Warning: {w}|" for w in ("M1 TimeO", "M2 TimeO", "Nv WayP")]
        if i < third:
            out.append(f"{alarm}: Health Warning: M3 TimeO| shown at {end}: again")
    out += [f"{alarm}: Health Warning: M3 TimeO_COM8|"] * odd
    out += [f"{alarm}: Health Warning: Nv WayP without its bar"]
    out += [f"{alarm}: idle"] * (total - len(out) - 1)
    return "\n".join([*out, f"{end}: closed"]) + "\n"


@pytest.fixture(scope="session")
def built_logs(tmp_path_factory):
    folder = tmp_path_factory.mktemp("logs") / "Built logs 006 - 007"
    write(folder, "EVT00006.txt", event_log(6, "14:34:33.6", "14:54:36.9", "14:34:54.3", [130.8, 131.3, 89.4, "0.0", 599.3, 326.2, "0.0", "0.0"], (211, 3, 1), 786))
    write(folder, "EVT00007.txt", event_log(7, "15:01:47.0", "15:17:01.7", "15:02:08.0", [131.4, 127.2, 86.8, "0.0", 593.7, 350.3, "0.0", "0.0"], (24, 8, 0), 236))
    return str(folder)


@pytest.fixture(scope="session", params=["built", *(["real"] if REAL_LOGS else [])])
def shipped(request, built_logs):
    return built_logs if request.param == "built" else os.path.dirname(REAL_LOGS[0])


def write(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


@pytest.fixture(scope="session")
def survey(tmp_path_factory):
    """Two complete sessions made by hand, in a folder whose name needs escaping, and a third
    with missing files."""
    folder = tmp_path_factory.mktemp("data") / "Ground test 1+2 100%"
    for n, clock in ((1, "14:34"), (2, "1434")):
        write(folder, f"EVT0000{n}.txt", LOG.format(n=n, clock=clock))
        write(folder, f"Cfg0000{n}.xml", CONFIG)
    write(folder, "MAG00001.txt", "\n".join([MAG_HEADER, *MAG_ROWS]) + "\n")
    # Another layout: Roll has data, Ralt is absent, Mag1 is whole numbers, and time passes midnight.
    write(folder, "MAG00002.txt", "\n".join([
        "      Time  Mag1 Mag2  Roll MagL",
        "######                     10.0",
        "235959.500 49000 1.5  0.10 10.5",
        "235959.750 49001 ###  0.20 11.0",
        "000000.000 49002 ###  #### 11.5",
        "000000.250 49003 2.5  0.30 12.0",
        "000000.500 49004 ###  0.30 12.5",
        "   \t ",
    ]) + "\n")
    gga = "    dTime  dSNo dHdop  Xdgps"
    write(folder, "GGA00001.txt", "\n".join([gga, "143433.10    12  0.80   10.5", "143433.20    13   1.0   10.5"]) + "\n")
    write(folder, "GGA00002.txt", gga + "\n")
    spc = "     Stime     Sk BaroV Sbin"
    write(folder, "SPC00001.txt", "\n".join([spc, "143433.000   5.25   1.0   a1", "143434.000   6.25   1.0   NA"]) + "\n")
    write(folder, "SPC00002.txt", "\n".join([spc, "143433.000   ####  1.00   a1"]) + "\n")
    write(folder, "EVT00003.txt", "no header date\n14:00:00.0: x\n")
    write(folder, "MAG00003.txt", "")
    return str(folder)
