"""The columns, types, keys and CHECK rules of all tables. Raw files are never inferred: an
empty day would lose its columns."""

from pyspark.sql.types import StructType

RAW_PHONE = (
    "ID string, Category string, Title string, Description string, Price double, Currency string, "
    "`Date` string, Address string, City string, Country string, Latitude double, Longitude double, "
    "url string"
)
RAW_MOTORCYCLE = RAW_PHONE + ", Brand string, Model string, Year string, Odometer string, OdometerUnits string"
RAW_CATALOGUE = "brand string, model string, url string"
RAW_BRANDS = "brand string, pattern string"
RAW_MODELS = "brand string, model string, url string, pattern string, length string"

_LISTING = (
    "id bigint NOT NULL, category string, "
    "info struct<title: string, description: string, url: string>, "
    "location struct<country: string, city: string, address: string, "
    "coordinate: struct<lat: double, lon: double>>, "
    "cost struct<currency: string, price: double>, `date` date, "
)
SILVER = {
    "cell_catalog": "brand string NOT NULL, model string NOT NULL, url string",
    "cell_models": "brand string NOT NULL, model string NOT NULL, pattern string NOT NULL, "
    "length int NOT NULL, url string",
    "cell_brands": "brand string NOT NULL, pattern string NOT NULL",
    "cell_listings": _LISTING + "processed_at timestamp",
    "motorcycle_listings": _LISTING
    + "model struct<brand: string, name: string, year: int>, "
    + "odometer struct<unit: string, value: bigint>, processed_at timestamp",
}
SILVER_KEYS = {
    "cell_catalog": ["brand", "model"],
    "cell_models": ["brand", "model"],
    "cell_brands": ["brand"],
    "cell_listings": ["id"],
    "motorcycle_listings": ["id"],
}

#: What ingests could not read: the file, why, and the text itself; ``kind`` is the silver table.
REJECTS = "kind string NOT NULL, file string, reason string NOT NULL, text string"

_VERSION = ", hash string NOT NULL, valid_from timestamp NOT NULL, valid_to timestamp"
LISTING = (
    "id bigint NOT NULL, category string NOT NULL, posted_at date NOT NULL, "
    "processed_at timestamp NOT NULL"
)
DIMENSIONS = {
    "info": "id bigint NOT NULL, title string NOT NULL, description string" + _VERSION,
    "location": "id bigint NOT NULL, country string NOT NULL, city string NOT NULL, "
    "address string NOT NULL, postal_code string, lat double NOT NULL, lon double NOT NULL" + _VERSION,
    "cost": "id bigint NOT NULL, currency string NOT NULL, price decimal(18,2) NOT NULL" + _VERSION,
    "electronic_brand": "id bigint NOT NULL, brand string NOT NULL, model string" + _VERSION,
    "storage": "id bigint NOT NULL, storage_gb int NOT NULL" + _VERSION,
    "vehicle_spec": "id bigint NOT NULL, brand string NOT NULL, model string NOT NULL, year int"
    + _VERSION,
    "odometer": "id bigint NOT NULL, units string NOT NULL, odometer int NOT NULL" + _VERSION,
}

_INTERVAL = {"valid_interval": "valid_to IS NULL OR valid_to > valid_from"}
CHECKS = {
    "info": {**_INTERVAL, "description_not_blank": "description IS NULL OR description <> ''"},
    "location": {
        **_INTERVAL,
        "lat_range": "lat BETWEEN -90 AND 90",
        "lon_range": "lon BETWEEN -180 AND 180",
    },
    "cost": {
        **_INTERVAL,
        "currency_length": "length(currency) = 3",
        "price_not_negative": "price >= 0",
    },
    "electronic_brand": _INTERVAL,
    "storage": {**_INTERVAL, "storage_positive": "storage_gb > 0"},
    "vehicle_spec": {
        **_INTERVAL,
        "year_range": "year BETWEEN 1900 AND year(current_date()) + 1",
    },
    "odometer": {
        **_INTERVAL,
        "units_known": "units IN ('km', 'mi')",
        "odometer_not_negative": "odometer >= 0",
    },
}


def columns(ddl: str) -> list[str]:
    return StructType.fromDDL(ddl).names


def required(ddl: str) -> list[str]:
    return [f.name for f in StructType.fromDDL(ddl).fields if not f.nullable]
