"""Lookup tables of the sensor system. All are constants of fixed size, safe to broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------
# Results depend on these words and numbers.
# ---------------------------------------------------------------------------------------

# sensor, port, label, full name, description, related MAG columns
SENSORS = [
    ("GEMK1", "COM3", "Magnetometer #1 (Port side)"),
    ("GEMK2", "COM4", "Magnetometer #2 (Starboard side)"),
    ("GDRAlt", "COM5", "Radar Altimeter"),
    ("GD485", "COM6", "ADC 4-channel VLF receiver (RS-485 bus)"),
    ("XSENS", "COM7", "AHRS / GPS attitude sensor"),
    ("GDGPS", "COM8", "Septentrio differential GPS"),
    ("GDSpec", "COM9", "Medusa Gamma-Ray Spectrometer"),
    ("GDLas", "COM10", "Laser Altimeter"),
]

COLUMN_DESCRIPTIONS = {
    "Xpr": "Sample/experiment counter",
    "M1st": "Mux1 status word",
    "M1clk": "Mux1 clock counter (ticks)",
    "Wayp": "Navigation waypoint number",
    "Date": "UTC date (YYYYMMDD)",
    "Time": "UTC time (HHMMSS.sss)",
    "Xgps": "GPS longitude (°)",
    "Ygps": "GPS latitude (°)",
    "Zgps": "GPS ellipsoidal altitude (m)",
    "Lalt": "Barometric/laser altimeter (m)",
    "Raltr": "Radar altimeter – raw channel (m)",
    "Ralt": "Radar altimeter – calibrated (m)",
    "Mag1": "Magnetometer 1 total field (nT)",
    "Mag2": "Magnetometer 2 total field (nT)",
    "Mag1D": "Mag1 first derivative (nT/s)",
    "Mag2D": "Mag2 first derivative (nT/s)",
    "Mag1C": "Mag1 compensated total field (nT)",
    "Mag2C": "Mag2 compensated total field (nT)",
    "MagL": "Mag2 – Mag1 difference field (nT)",
    "MagLC": "Compensated Mag2 – Mag1 difference (nT)",
    "A1": "Mag1 amplitude/gain flag",
    "T1": "Mag1 sensor temperature (°C)",
    "X1": "Mag1 X-axis status flag (1=OK)",
    "Y1": "Mag1 Y-axis status flag (1=OK)",
    "Z1": "Mag1 Z-axis status flag (1=OK)",
    "A2": "Mag2 amplitude/gain flag",
    "T2": "Mag2 sensor temperature (°C)",
    "X2": "Mag2 X-axis status flag (1=OK)",
    "Y2": "Mag2 Y-axis status flag (1=OK)",
    "Z2": "Mag2 Z-axis status flag (1=OK)",
    "Vlf1": "VLF EM channel 1 (ADC count)",
    "Vlf2": "VLF EM channel 2 (ADC count)",
    "Vlf3": "VLF EM channel 3 (ADC count)",
    "Vlf4": "VLF EM channel 4 (ADC count)",
    "Roll": "Roll angle (°, XSENS IMU)",
    "Pitch": "Pitch angle (°, XSENS IMU)",
    "Yaw": "Yaw/heading angle (°, XSENS IMU)",
    "Xst": "System status hex string",
    "Bin": "Raw binary sensor data",
    "M3st": "Mux3 status word",
    "M3clk": "Mux3 clock counter",
    "dWayp": "dGPS waypoint",
    "dTime": "dGPS UTC time (HHMMSS.ss)",
    "Xdgps": "Differential GPS longitude (°)",
    "Ydgps": "Differential GPS latitude (°)",
    "Zdgps": "Differential GPS altitude (m)",
    "dSNo": "Number of GPS satellites",
    "dHdop": "Horizontal dilution of precision (lower=better)",
    "dDOn": "Differential correction on (1=yes)",
    "dAge": "Age of differential correction (s)",
    "dSID": "Differential reference station ID",
    "M2st": "Mux2 status word",
    "M2clk": "Mux2 clock counter",
    "Sdate": "Spectrometer UTC date",
    "Stime": "Spectrometer UTC time",
    "Swayp": "Spectrometer waypoint",
    "Sxgps": "Spectrometer GPS longitude (°)",
    "Sygps": "Spectrometer GPS latitude (°)",
    "Szgps": "Spectrometer GPS altitude (m)",
    "Sralt": "Spectrometer radar altimeter (m)",
    "BaroV": "Barometric pressure voltage (V)",
    "TempV": "Temperature sensor voltage (V)",
    "HumdV": "Humidity sensor voltage (V)",
    "Sbaro": "Barometric pressure raw counts",
    "Stemp": "Temperature raw counts",
    "Shumd": "Humidity raw counts",
    "Sreal": "Spectrometer real-time count rate",
    "Slive": "Spectrometer live-time count rate",
    "Srate": "Spectrometer acquisition rate",
    "Sk": "Spectrometer potassium channel (K)",
    "Su": "Spectrometer uranium channel (U)",
    "Sth": "Spectrometer thorium channel (Th)",
    "Sa0": "Spectrometer background channel 0",
    "Sa1": "Spectrometer background channel 1",
    "Sa2": "Spectrometer background channel 2",
    "Sbin": "Raw spectral binary data",
}

# channel, unit, largest standard deviation that counts as stable
THRESHOLDS = [
    ("Mag1", "nT", 10.0), ("Mag2", "nT", 10.0), ("Mag1C", "nT", 10.0), ("Mag2C", "nT", 10.0),
    ("Roll", "°", 1.0), ("Pitch", "°", 1.0), ("Yaw", "°", 2.0),
    ("Ralt", "m", 0.5), ("Raltr", "m", 0.5),
    ("Xgps", "°", 0.001), ("Ygps", "°", 0.001),
    ("Xdgps", "°", 5e-5), ("Ydgps", "°", 5e-5),
    ("dHdop", "", 1.0),
]

WARNING_MEANINGS = [
    ("M1 TimeO", "Mux1 timeout – sensor not responding within 80 ms"),
    ("M2 TimeO", "Mux2 timeout – sensor not responding within 200 ms"),
    ("M3 TimeO", "Mux3 timeout – sensor not responding within 100 ms"),
    ("Nv WayP", "Navigation waypoint missing (normal on ground – no flight plan active)"),
]

MUX_TIMEOUTS = ["M1 TimeO", "M2 TimeO", "M3 TimeO"]

# sensor -> MAG channels that must hold data when the sensor is connected
SENSOR_CHANNELS = {
    "GEMK1": ["Mag1", "Mag1D", "Mag1C"],
    "GEMK2": ["Mag2", "Mag2D", "Mag2C"],
    "GDRAlt": ["Ralt", "Raltr"],
    "GD485": ["MagL", "MagLC"],
    "XSENS": ["Roll", "Pitch", "Yaw"],
    "GDGPS": ["Xgps", "Ygps", "Zgps", "Lalt"],
    "GDSpec": ["Vlf1", "Vlf2", "Vlf3", "Vlf4"],
}

TEXT_CHANNELS = ["Xst", "Bin", "Sbin"]

TIME_CHANNEL = {"MAG": "Time", "GGA": "dTime", "SPC": "Stime"}

SKIP_CHANNELS = {
    "MAG": ["Date", "Time", "M1st", "M1clk", "Xpr", "Wayp", "Xst", "Bin"],
    "GGA": ["M3st", "M3clk", "dWayp", "dTime"],
    "SPC": ["M2st", "M2clk", "Sdate", "Stime", "Swayp", "Sbin"],
}

ANALYSIS_CHANNELS = {
    "MAG": ["Mag1", "Mag2", "Mag1C", "Mag2C", "Mag1D", "Mag2D", "MagL", "MagLC",
            "Roll", "Pitch", "Yaw", "Ralt", "Raltr", "Xgps", "Ygps", "Zgps"],
    "GGA": ["Xdgps", "Ydgps", "Zdgps", "dSNo", "dHdop", "dAge"],
    "SPC": ["BaroV", "Sralt", "Sk", "Su", "Sth", "Sbaro", "Stemp", "Shumd"],
}

COMPARE_CHANNELS = {
    "MAG": ["Mag1", "Mag2", "Mag1C", "Mag2C", "Roll", "Pitch", "Yaw", "Ralt"],
    "GGA": ["dHdop", "dSNo"],
    "SPC": ["Sk", "Su", "Sth"],
}

GPS_CHANNELS = [("dSNo", "Satellites"), ("dHdop", "HDOP"), ("dAge", "Diff age (s)")]
POSITION_CHANNELS = ["Xdgps", "Ydgps"]
ENVIRONMENT_CHANNELS = ["Sralt", "BaroV", "TempV", "HumdV", "Sk", "Su", "Sth", "Sbaro", "Stemp", "Shumd"]
RADIOMETRIC_CHANNELS = ["Sk", "Su", "Sth"]

PLOT_SETS = {
    "MAG": {"mag_raw": ["Mag1", "Mag2"], "attitude": ["Roll", "Pitch", "Yaw"], "radar_alt": ["Ralt"]},
    "GGA": {"gps_quality": ["dHdop", "dSNo"]},
    "SPC": {"spc_channels": ["Sk", "Su", "Sth", "BaroV", "Sbaro"]},
}

CONFIG_SUMMARY_TAGS = {
    "COMPNAME": "compensation", "NAVNAME": "nav_file", "PORTNUM": "clock_port",
    "WEBHOST": "web_host", "LINENUM": "line_num", "LOGLEVEL": "log_level",
}

CONSTANT_STD = 0.001
EXCELLENT_HDOP = 1.0

# ---------------------------------------------------------------------------------------
# The same values as DataFrames
# ---------------------------------------------------------------------------------------


def sensor_ref(spark: SparkSession) -> DataFrame:
    rows = [(i, *s) for i, s in enumerate(SENSORS)]
    return spark.createDataFrame(
        rows,
        "ordinal INT, sensor STRING, port STRING, full_name STRING",
    )


def column_desc(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(COLUMN_DESCRIPTIONS.items()), "channel STRING, description STRING")


def thresholds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(THRESHOLDS, "channel STRING, unit STRING, max_std DOUBLE")


def warn_meaning(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(WARNING_MEANINGS, "warning STRING, meaning STRING")


def sensor_channels(spark: SparkSession) -> DataFrame:
    rows = [(s, c, i) for s, channels in SENSOR_CHANNELS.items() for i, c in enumerate(channels)]
    return spark.createDataFrame(rows, "sensor STRING, channel STRING, ordinal INT")


def skip_channels(spark: SparkSession) -> DataFrame:
    rows = [(kind, c) for kind, channels in SKIP_CHANNELS.items() for c in channels]
    return spark.createDataFrame(rows, "kind STRING, channel STRING")


def per_row(df: DataFrame, rows: list[dict]) -> DataFrame:
    """Repeat each row of ``df`` once per constant row: a literal array exploded in place.

    The constants are part of the plan, so neither a join nor a shuffle is involved.
    """
    literals = [F.struct(*[F.lit(v).alias(k) for k, v in r.items()]) for r in rows]
    return df.select("*", F.inline(F.array(*literals)))
