"""Preset for used-vehicle listings: column roles, word lists and limits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TARGET = "price"

# --- Fixed values: places, words and limits that results depend on ----------------------

# New York, Los Angeles, Chicago, Houston, Phoenix, Philadelphia, San Antonio, San Diego,
# Dallas, San Jose, Miami, Atlanta, Seattle, Denver, Boston
CITY_CENTRES = (
    (40.7128, -74.0060), (34.0522, -118.2437), (41.8781, -87.6298), (29.7604, -95.3698),
    (33.4484, -112.0740), (39.9526, -75.1652), (29.4241, -98.4936), (32.7157, -117.1611),
    (32.7767, -96.7970), (37.3382, -121.8863), (25.7617, -80.1918), (33.7490, -84.3880),
    (47.6062, -122.3321), (39.7392, -104.9903), (42.3601, -71.0589),
)
PREMIUM_MAKES = (
    "bmw", "mercedes-benz", "audi", "porsche", "lexus", "tesla", "ferrari", "mclaren", "lamborghini",
    "bentley", "rolls-royce", "aston martin", "maserati", "bugatti", "pagani", "koenigsegg",
)
LOW_PRICE = 4000
PREMIUM_BODIES = ("coupe", "convertible")
MASS_MARKET_MAKES = (
    "Ford", "Chevrolet", "Nissan", "Dodge", "Toyota", "Honda", "Hyundai", "Kia", "GMC", "Jeep", "RAM", "Buick",
)
FUEL_RULES = (
    ("gas", "gasoline"), ("diesel", "diesel"), ("hybrid", "hybrid"), ("electric", "electric"), ("flex", "flex_fuel"),
)
OPTION_TERMS = (
    "offroadpackage", "navigationsystem", "thirdrowseating", "sunroof/moonroof", "parkingsensors", "heatedseats",
    "adaptivecruisecontrol", "blindspotmonitoring", "backupcamera", "leatherseats", "multizoneclimatecontrol",
)
EXCLUDED_OPTIONS = (
    "quickorderpackage", "steelwheels", "conveniencepackage", "premiumpackage", "towpackage", "appearancepackage",
    "powerpackage", "technologypackage", "preferredpackage", "coldweatherpackage", "heatpackage", "sepackage",
    "premiumwheels", "chromewheels",
)
FUNCTIONAL_GROUPS = {
    "technical": ("engine_displacement", "horsepower", "fuel_type"),
    "usage": ("mileage", "owner_count", "daysonmarket"),
    "condition": ("has_accidents", "frame_damaged", "salvage"),
    "commercial": ("price", "seller_rating", "is_certified"),
}

# --- Fixed values: column roles ---------------------------------------------------------

IDENTIFIERS = ("vin", "listing_id", "sp_id")
MEASURES = (
    "power", "torque", "back_legroom", "front_legroom", "fuel_tank_volume", "height", "length", "maximum_seating",
    "wheelbase", "width",
)
CYLINDERS = ("engine_cylinders",)
BOOLEANS = (
    "fleet", "frame_damaged", "franchise_dealer", "has_accidents", "isCab", "is_cpo", "is_new", "is_oemcpo",
    "salvage", "theft_title",
)
DAMAGE = ("salvage", "frame_damaged", "theft_title", "has_accidents")
CATEGORIES = (
    "body_type", "fuel_type", "transmission", "make_name", "model_name", "exterior_color", "interior_color",
    "wheel_system",
)
FREQUENCY_CATEGORIES = (
    "body_type", "fuel_type", "make_name", "model_name", "transmission", "transmission_display", "wheel_system",
    "wheel_system_display", "listing_color", "exterior_color", "interior_color", "trim_name",
)
TEXTS = ("description", "major_options")
PREVIEW = (
    "vin", "make_name", "model_name", "year", "price", "mileage", "body_type", "fuel_type", "transmission_display",
)
EXPENSIVE_CONTEXT = (
    "make_name", "model_name", "trim_name", "year", "body_type", "fuel_type", "is_new", "mileage", "horsepower",
)
TOP_ROW_CONTEXT = ("model_name", "trim_name", "year", "body_type", "is_new", "mileage", "horsepower")
OUTLIER_SEGMENTS = ("make_name", "body_type", "is_new")

# --- Fixed values: preparation ----------------------------------------------------------

UNUSED = (
    "combine_fuel_economy", "is_certified", "vehicle_damage_category", "vin", "listing_id", "sp_id",
    "main_picture_url", "transmission_display", "wheel_system_display", "listing_color", "dealer_zip", "sp_name",
    "bed", "cabin", "is_cpo", "is_oemcpo", "isCab", "franchise_make",
)
UNUSED_AFTER = (
    "engine_displacement", "city_fuel_economy", "power", "torque", "engine_cylinders", "trimId", "listed_date",
    "bed_height", "bed_length", "major_options", "description", "geo_region", "urban_level",
    "dist_to_major_city_miles", "is_classic", "listed_year", "listed_month", "frame_damaged", "salvage", "theft_title",
)
TRUCK_DETAILS = ("bed", "bed_height", "bed_length", "cabin")
BOOLEAN_CATEGORIES = ("fleet", "has_accidents")
UNKNOWN_FILLS = ("interior_color", "body_type", "engine_type", "transmission", "trim_name", "wheel_system")
OVERALL_DIMENSIONS = ("height_num", "length_num", "width_num", "wheelbase_num")

# Blocks of columns that share the groups their medians are taken over.
IMPUTATION_BLOCKS = (
    (("height_num", "length_num", "width_num", "wheelbase_num", "maximum_seating_num", "front_legroom_num",
      "back_legroom_num"), ("body_type", "is_pickup")),
    (("power_num", "torque_num", "engine_cylinders_num", "engine_displacement", "fuel_tank_volume_num"),
     ("body_type", "fuel_type_clean", "gama_alta")),
    # Fuel economy and the remaining measures use the same groups, so they share one pass.
    (("city_fuel_economy", "highway_fuel_economy", "horsepower", "mileage", "seller_rating"),
     ("body_type", "fuel_type_clean", "is_new")),
)
FALLBACK_AGE = 5.0

# --- Fixed values: modelling ------------------------------------------------------------

LABEL = "log_price"
UNUSED_IN_MODEL = ("city", "exterior_color", "interior_color", "model_name", "trim_name")
MODEL_CATEGORIES = (
    "make_name", "body_type", "fuel_type_clean", "engine_type", "fleet", "has_accidents", "transmission",
    "wheel_system", "segmento_estado",
)
MODEL_BOOLEANS = ("is_new", "franchise_dealer")
_MODEL_MEASURES = (
    "latitude", "longitude", "gama_alta", "is_pickup", "daysonmarket", "highway_fuel_economy", "horsepower",
    "mileage", "owner_count", "seller_rating", "year", "vehicle_age_at_listing", "missing_dimensions",
    "power_density", "description_length", "option_count",
)
MODEL_NUMERICS = (
    *_MODEL_MEASURES,
    *(f"{c}_num" for c in (*MEASURES, *CYLINDERS)),
    "owner_count_missing",
    *(f"{c}_missing" for cols, _ in IMPUTATION_BLOCKS for c in cols),
    *("has_" + term.replace("/", "_") for term in OPTION_TERMS),
)


def age_body_stratum() -> Column:
    """Sampling stratum: three bins of model year crossed with body type."""
    bins = F.when(F.col("year") >= 2019, "recent").when(F.col("year") >= 2014, "mid").otherwise("old")
    return F.concat_ws("_", bins, F.coalesce(F.trim("body_type"), F.lit("unknown")))
