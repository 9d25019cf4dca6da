"""Input tables of the registered queries, and listings derived from ``lineitem``.

The derived columns are plain expressions that Spark and the checking database read alike.
They cover what a raw listings table holds: nulls, blanks, placeholders, sentinels, numbers
in text, impossible coordinates and years, and one make with a third of all rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tabwright.operators.quantile import EXACT
from tabwright.session import tune
from tabwright.sources.staging import shared_folder

# Registered queries take exact quantiles, whatever the size of a group.
ACCURACY = EXACT

_MIX = "l_orderkey * 31 + l_partkey * 17 + l_suppkey * 7 + l_linenumber * 3 AS h"


def _text(n: str) -> str:
    return f"CAST({n} AS STRING)"


def _real(n: str) -> str:
    return f"CAST({n} AS DOUBLE)"


def _pick(key: str, *options: str) -> str:
    """A CASE over the remainder of ``key``; the text NULL stays a null."""
    shown = [o if o == "NULL" else f"'{o}'" for o in options]
    arms = " ".join(f"WHEN {i} THEN {o}" for i, o in enumerate(shown[:-1]))
    return f"CASE ({key}) % {len(options)} {arms} ELSE {shown[-1]} END"


def _null(every: int, expr: str) -> str:
    return f"CASE WHEN h % {every} = 0 THEN NULL ELSE {expr} END"


def _measure(every: int, low: int, span: int, unit: str) -> str:
    number = f"{_text(f'{low} + h % {span}')} || '.' || {_text('h % 10')} || ' {unit}'"
    return f"CASE WHEN h % {every} = 0 THEN NULL WHEN h % {every} = 1 THEN '--' WHEN h % {every} = 2 THEN '' ELSE {number} END"


_OPTIONS = '["Navigation System", "Sunroof/Moonroof", "{}"]'

# name -> (kind, expression)
LISTING_COLUMNS: dict[str, tuple[str, str]] = {
    "vin": ("string", "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || "
                      "CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING)"),
    "listing_id": ("bigint", "l_orderkey"),
    "sp_id": ("bigint", _null(71, "l_suppkey")),
    "price": ("double", "CASE WHEN h % 211 = 0 THEN NULL WHEN h % 401 = 0 THEN 0e0 "
                        "WHEN h % 997 = 0 THEN l_extendedprice * 8e0 ELSE l_extendedprice END"),
    "mileage": ("double", f"CASE WHEN h % 41 = 0 THEN NULL WHEN h % 601 = 0 THEN 99999999e0 "
                          f"WHEN h % 4 = 0 THEN {_real('h % 700')} ELSE {_real('h % 180000')} * 15e-1 END"),
    "daysonmarket": ("int", "CASE WHEN h % 43 = 0 THEN NULL WHEN h % 307 = 0 THEN -1 ELSE CAST(h % 400 AS INT) END"),
    "year": ("int", "CASE WHEN h % 67 = 0 THEN NULL WHEN h % 509 = 0 THEN 1890 WHEN h % 521 = 0 THEN 2150 "
                    "ELSE CAST(1970 + h % 57 AS INT) END"),
    "horsepower": ("double", _null(29, _real("90 + h % 420"))),
    "engine_displacement": ("double", f"CASE WHEN h % 31 = 0 THEN NULL WHEN h % 61 = 0 THEN 0e0 "
                                      f"ELSE {_real('1000 + (h % 50) * 100')} END"),
    "city_fuel_economy": ("double", _null(19, _real("12 + h % 30"))),
    "highway_fuel_economy": ("double", _null(17, _real("17 + h % 30 + h % 4"))),
    "seller_rating": ("double", _null(83, f"1e0 + {_real('h % 40')} / 1e1")),
    "owner_count": ("double", f"CASE WHEN h % 5 < 2 THEN NULL ELSE {_real('1 + h % 4')} END"),
    "savings_amount": ("double", f"CASE WHEN h % 3 = 0 THEN 0e0 ELSE {_real('h % 1000')} END"),
    "latitude": ("double", f"CASE WHEN h % 37 = 0 THEN NULL WHEN h % 499 = 0 THEN 0e0 WHEN h % 503 = 0 THEN 95e0 "
                           f"ELSE 25e0 + {_real('h % 2400')} / 1e2 END"),
    "longitude": ("double", f"CASE WHEN h % 37 = 0 THEN NULL WHEN h % 499 = 0 THEN 0e0 WHEN h % 541 = 0 THEN 0e0 "
                            f"ELSE -124e0 + {_real('h % 5800')} / 1e2 END"),
    "listed_date": ("date", _null(53, "CAST(l_shipdate AS DATE)")),
    "make_name": ("string", "CASE WHEN h % 227 = 0 THEN NULL WHEN h % 3 = 0 THEN 'Ford' ELSE "
                  + _pick("h", "Chevrolet", "Nissan", "Dodge", "Toyota", "Honda", "Hyundai", "Kia", "GMC", "Jeep",
                          "RAM", "Buick", "BMW", "Porsche", "Tesla", " Lexus ", "Mazda", "Subaru", "Volvo", "Acura")
                  + " END"),
    "model_name": ("string", f"'Model ' || {_text('h % 40')}"),
    "trim_name": ("string", _null(13, f"'Trim ' || {_text('h % 25')}")),
    "body_type": ("string", _pick("h", "SUV / Crossover", "Sedan", "Pickup Truck", "Coupe", "Convertible", "Minivan",
                                  "Hatchback", "Wagon ", "NULL")),
    "fuel_type": ("string", _pick("h", "Gasoline", "Diesel", "Hybrid", "Electric", "Flex Fuel Vehicle",
                                  "Compressed Natural Gas", "Hydrogen", "NULL")),
    "transmission": ("string", _pick("h", "A", "M", "CVT", "NULL", "A")),
    "transmission_display": ("string", _pick("h", "a", "M ", "Continuously Variable", "NULL", "A")),
    "wheel_system": ("string", _pick("h", "FWD", "AWD", "4WD", "RWD", "NULL", "4X2")),
    "wheel_system_display": ("string", _pick("h", "Front", "awd", "4wd", "Rear", "NULL", "")),
    "exterior_color": ("string", f"'Shade ' || {_text('h % 300')}"),
    "listing_color": ("string", f"'SHADE ' || {_text('h % 300')}"),
    "interior_color": ("string", _pick("h", "Black", "Gray", "NULL", "none", "  ", "Beige", "N/A")),
    "engine_type": ("string", _pick("h", "I4", "V6", "V8", "NULL", "H4")),
    "trimId": ("string", f"'t' || {_text('h % 900')}"),
    "franchise_make": ("string", _pick("h", "Ford", "Kia", "NULL")),
    "sp_name": ("string", f"'Dealer ' || {_text('l_suppkey')}"),
    "main_picture_url": ("string", f"'https://pictures.example/' || {_text('l_orderkey')}"),
    "city": ("string", f"CASE WHEN h % 47 = 0 THEN NULL WHEN h % 59 = 0 THEN ' ' ELSE 'City ' || {_text('h % 120')} END"),
    "dealer_zip": ("string", _null(89, _text("10000 + h % 900"))),
    "power": ("string", f"CASE WHEN h % 13 = 0 THEN NULL WHEN h % 13 = 1 THEN '--' WHEN h % 13 = 2 THEN '' "
                        f"ELSE {_text('90 + h % 420')} || ' hp @ 5,600 RPM' END"),
    "torque": ("string", f"CASE WHEN h % 11 = 0 THEN NULL WHEN h % 11 = 1 THEN 'na' "
                         f"ELSE {_text('80 + h % 400')} || ' lb-ft' END"),
    "engine_cylinders": ("string", _pick("h", "I4", "V6", "V8", "NULL", "H4", "electric")),
    "back_legroom": ("string", _measure(7, 30, 15, "in")),
    "front_legroom": ("string", _measure(9, 38, 8, "in")),
    "fuel_tank_volume": ("string", _measure(8, 10, 25, "gal")),
    "height": ("string", _measure(6, 50, 30, "in")),
    "length": ("string", _measure(6, 150, 90, "in")),
    "maximum_seating": ("string", f"CASE WHEN h % 10 = 0 THEN NULL ELSE {_text('2 + h % 7')} || ' seats' END"),
    "wheelbase": ("string", _measure(6, 90, 60, "in")),
    "width": ("string", _measure(6, 65, 25, "in")),
    "bed": ("string", _pick("h", "Short", "--", "null", "NULL", "Long", "")),
    "bed_height": ("string", _pick("h", "21 in", "--", "None", "NULL", "NULL")),
    "bed_length": ("string", _pick("h", "67.1 in", "NULL", "78 in", "")),
    "cabin": ("string", _pick("h", "Crew Cab", "NULL", "Extended Cab", "--")),
    "is_new": ("boolean", _null(59, "(h % 4 = 0)")),
    "franchise_dealer": ("boolean", "(h % 3 <> 0)"),
    "fleet": ("boolean", "CASE WHEN h % 2 = 0 THEN NULL ELSE (h % 5 = 0) END"),
    "frame_damaged": ("boolean", "CASE WHEN h % 2 = 0 THEN NULL ELSE (h % 97 = 0) END"),
    "has_accidents": ("boolean", "CASE WHEN h % 2 = 0 THEN NULL ELSE (h % 6 = 1) END"),
    "isCab": ("boolean", "CASE WHEN h % 3 <> 0 THEN NULL ELSE (h % 101 = 0) END"),
    "is_cpo": ("boolean", "CASE WHEN h % 10 <> 0 THEN NULL ELSE TRUE END"),
    "is_oemcpo": ("boolean", "CASE WHEN h % 20 <> 0 THEN NULL ELSE (h % 3 = 0) END"),
    "salvage": ("boolean", "CASE WHEN h % 2 = 0 THEN NULL ELSE (h % 89 = 0) END"),
    "theft_title": ("boolean", "CASE WHEN h % 2 = 0 THEN NULL ELSE (h % 211 = 0) END"),
    "major_options": ("string", "CASE h % 7 WHEN 0 THEN NULL WHEN 1 THEN '[]' "
                      + f"WHEN 2 THEN '{_OPTIONS.format('Leather Seats')}' WHEN 3 THEN '{_OPTIONS.format('Backup Camera')}' "
                      + f"WHEN 4 THEN '{_OPTIONS.format('Quick Order Package')}' "
                      + "WHEN 5 THEN '[\"Heated Seats\", \"LE\"]' "
                      + "ELSE '[\"Multi Zone Climate Control\", \"Third Row Seating\", \"Tow Package\"]' END"),
    "description": ("string", f"CASE WHEN h % 11 = 0 THEN NULL WHEN h % 13 = 0 THEN '   ' "
                              f"ELSE ' Offered by dealer ' || {_text('l_suppkey')} || repeat(' again', CAST(h % 60 AS INT)) END"),
}

LISTINGS_SQL = (
    "SELECT " + ", ".join(f"{expr} AS {name}" for name, (_, expr) in LISTING_COLUMNS.items())
    + f" FROM (SELECT *, {_MIX} FROM lineitem) AS mixed"
)


def _derive(lineitem: DataFrame) -> DataFrame:
    mixed = lineitem.selectExpr("*", _MIX)
    return mixed.selectExpr(*[f"{expr} AS {name}" for name, (_, expr) in LISTING_COLUMNS.items()])


class Tables:
    """The driver's tables under one folder, and the derived listings."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = tune(spark)  # listings have sixty columns
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def new_path(self) -> str:
        """A path of its own in the folder that all executors share."""
        return f"{shared_folder(self.spark)}/tabwright/{uuid.uuid4().hex}"

    @property
    def listings(self) -> DataFrame:
        return _derive(self.lineitem)
