"""Fixed values. Results depend on these exact word lists, patterns and limits."""

# Storage-size patterns as (unit, pattern), best priority first.
STORAGE_PATTERNS = [
    ("GB", r"\b(?!0{3})(\d{3})\s*(gb|gigs|gib)\b"),
    ("GB", r"\b(?!0{2})(32|64)\s*(gb|gigs|gib)\b"),
    ("TB", r"\b([1-8])\s*(tb)\b"),
    ("GB", r"\b(?!0{4})(\d{4})\s*(gb|gigs|gib)\b"),
    ("GB", r"\b(?!0{3,4})(\d{3,4})\s*(go)\b"),
    ("GB", r"\b(?!0{3,4})(128|256|512|1000|1024|2000|2048)\s*(g)\b"),
    ("GB", r"\b(?!0{2})(\d{2})\s*(gb|gigs|gib)\b"),
    ("GB", r"\b(?!0{2})(\d{2})\s*(go)\b"),
    ("GB", r"\b([1-9])\s*(gb|gigs|gib)\b"),
    ("GB", r"\b([1-9])\s*(go)\b"),
    ("GB", r"\b(?!0{2,4})(\d{2,4})\s*(g)\b"),
    ("GB", r"\b([126789])\s*(g)\b"),
]
# Any text that one of the patterns above matches also matches this one.
STORAGE_HINT = r"\d\s*(?:gb|gigs|gib|go|g|tb)\b"
GB_PER_TB = 1024

# Fixed value: Canadian postal code, second half optional.
POSTAL_CODE = r"(?i)\b(([A-Z][0-9][A-Z])\s?([0-9][A-Z][0-9])?)\b"

# Limits and defaults of the cleaning rules.
MAX_BRANDS_PER_AD = 3
WIDE_MAX_BRANDS = 2  # of the wide row
MODEL_HITS_TO_REJECT = 10
DEFAULT_CURRENCY = "CAD"
CURRENCY_LENGTH = 3
FIRST_VEHICLE_YEAR = 1900
ODOMETER_UNITS = ["km", "mi"]
MODELS_PER_CATALOGUE_PAGE = 50

# Brands of interest, those matched by their own name, and the aliases of the rest.
FOCUS_BRANDS = [
    "Apple", "Samsung", "Motorola", "Google", "HTC", "Huawei", "Nokia", "OnePlus", "ZTE", "vivo",
    "Xiaomi", "Oppo", "Lenovo", "Sony", "Realme", "LG", "Honor", "Asus", "BlackBerry", "TCL",
]
PLAIN_BRANDS = [
    "HTC", "Huawei", "Nokia", "ZTE", "vivo", "Xiaomi", "Oppo", "Lenovo", "Sony", "Realme", "Honor",
    "Asus", "BlackBerry", "TCL",
]
BRAND_ALIASES = {
    "Apple": r"\b(apple|iphone)\b",
    "Samsung": r"\b(samsung|galaxy)\b",
    "Google": r"\b(google|pixel)\b",
    "Motorola": r"\b(motorola|moto)\b",
    "LG": r"\blg\b",
    "OnePlus": r"\bone\s*plus\b",
}

# How catalogue names of each brand become model names and patterns.
# `clean` steps run on the name in order: discard/keep rows by regex, erase a regex, erase a literal,
# name a blank, refuse an exact name. `shape` steps then turn the model name into a pattern:
# split(regex, groups) puts spaces around the first word it matches, swap is a regex replacement.
MODEL_RULES = {
    "Apple": {
        "clean": [
            ("discard", r"(?i)(ipad|watch|CDMA)"),
            ("erase", r"\(.*\)"),
            ("erase", r"(?i)iphone"),
            ("squeeze",),
            ("refuse", ""),
        ],
        "shape": [("split", r"(\d+)([cegs]+)", 2), ("squeeze",)],
    },
    "Samsung": {
        "clean": [
            ("discard", r"(?i)(watch|tab|sgh)"),
            ("erase", r"(?i)(4g|5g|\(.*\))"),
            ("keep", r"(?i)galaxy"),
            ("erase_literal", "Galaxy"),
            ("squeeze",),
        ],
        "shape": [
            ("split", r"([a-z]+)(\d+)([a-z]?)", 3),
            ("swap", r"\b0", "0?"),
            ("swap", r"\bA\s", "A"),
            ("squeeze",),
        ],
    },
    "Google": {
        "clean": [
            ("discard", r"(?i)(watch|tablet)"),
            ("erase_literal", "Pixel"),
            ("erase_literal", "5G"),
            ("squeeze",),
            ("name_blank", "1"),
            ("refuse", "C"),
        ],
        "shape": [],
    },
    "Motorola": {
        "clean": [
            ("keep", r"\b(DROID|Edge|Moto|Nexus|One|Razr|ThinkPhone)\b"),
            ("discard", r"(?i)(watch|pad|dual|tab|360|uw|xyboard)"),
            ("erase", r"(?i)(4G|5G|\(.*\))"),
            ("erase", r"20\d{2}"),
            ("erase_literal", "Moto"),
            ("squeeze",),
        ],
        "shape": [("split", r"([a-z]*)(\d+)(s?)", 3), ("squeeze",)],
    },
    "LG": {
        "clean": [
            ("discard", r"(?i)(pad|watch|optimus|uw|dual|lte)"),
            ("discard", r"\b\w\d{3,4}\b"),
            ("erase", r"(?i)(\(.*\)|5g|thinQ)"),
            ("keep", r"\b(G|K|Q|V)\d*\b|\b(?i:nexus|stylo|stylus|velvet)\b"),
            ("squeeze",),
        ],
        "shape": [("split", r"([a-z]+)(\d+)", 2), ("swap", r"\s+A\b", "A"), ("squeeze",)],
    },
    "OnePlus": {
        "clean": [
            ("discard", r"(?i)(watch|pad|uw)"),
            ("erase", r"(?i)(5g|mclaren|racing|150w|\(.*\))"),
            ("squeeze",),
        ],
        "shape": [
            ("squeeze",),
            ("split", r"(\d+)([a-z\+]+)", 2),
            ("split", r"([a-z]+)(\d+)", 2),
            ("squeeze",),
        ],
    },
}

# Keys of the JSON-LD object of a listing page, in reading order,
# as (record column, path, kind); `number` must convert to a double.
PRODUCT_FIELDS = [
    ("Title", "$.name", "text"),
    ("Description", "$.description", "text"),
    ("Price", "$.offers.price", "number"),
    ("Currency", "$.offers.priceCurrency", "text"),
    ("Date", "$.offers.validFrom", "text"),
    ("Address", "$.offers.availableAtOrFrom.address.streetAddress", "text"),
    ("City", "$.offers.availableAtOrFrom.address.addressLocality", "text"),
    ("Country", "$.offers.availableAtOrFrom.address.addressCountry", "text"),
    ("Latitude", "$.offers.availableAtOrFrom.latitude", "number"),
    ("Longitude", "$.offers.availableAtOrFrom.longitude", "number"),
]
MOTORCYCLE_FIELDS = [
    ("Brand", "$.brand.name", "text"),
    ("Model", "$.model", "text"),
    ("Year", "$.vehicleModelDate", "text"),
    ("Odometer", "$.mileageFromOdometer.value", "text"),
    ("OdometerUnits", "$.mileageFromOdometer.unitCode", "text"),
]

# The tables exported as CSV.
GOLD_EXPORT = [
    "cost", "electronic_brand", "info", "listing", "location", "odometer", "storage", "vehicle_spec",
]

# Page markers.
SEARCH_LIST = ("ul", "data-testid", "srp-search-list")
RESULT_HEADER = ("h2", "data-testid", "srp-results")
CARD_MARK = "listing-card"
CARD_ID = "data-listingid"
LINK_MARK = "listing-link"
BRAND_TABLE = ("div", "class", "st-text")
BRAND_CELL = r">([^<]+)<br\s*/?><span>(\d+).+</span>"
PAGE_LINKS = ("div", "class", "nav-pages")
MODEL_LIST = ("div", "class", "makers")
