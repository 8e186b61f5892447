"""Fixed values that results depend on."""

# Predicted quantities, in output order.
TARGETS = ["Al", "B", "Ca", "Cu", "Fe", "K", "Mg", "Mn", "N", "Na", "P", "S", "Zn"]

# Laboratory chemistry columns, and target pairs whose ratios are features.
CHEMISTRY = ["ph", "electrical_conductivity", "C_organic", "C_total"]
RATIO_PAIRS = [("Ca", "Mg"), ("Fe", "Mn"), ("K", "Na"), ("Ca", "K")]
EPSILON = 1e-6

# Depth thresholds (cm) and date defaults of the two feature profiles.
SHALLOW_MAX = {"split": 20.0, "regex": 15.0}
DEEP_MIN = {"split": 20.0, "regex": 30.0}
DEFAULT_START_YEAR, DEFAULT_START_MONTH = 2013, 6
DEFAULT_END_YEAR, DEFAULT_END_MONTH = 2018, 12
DEFAULT_DECADE = 2010
WET_MONTHS = [3, 4, 5, 10, 11]
UNKNOWN_LABEL = "unknown"

# Accepted date layouts, tried in this order.
DATE_LAYOUTS = ["d/M/yyyy", "yyyy-MM-dd", "d-M-yyyy"]

# Block size in degrees, number of folds, cluster counts, batch sizes.
BLOCK_DEGREES = 0.5
FOLDS = 5
CLUSTERS = {"split": 50, "regex": 30}
BATCH_ROWS = 100
SEED = 42

# Gridded soil properties and depth labels.
SOIL_PROPERTIES = ["phh2o", "clay", "sand", "silt", "soc", "cec", "bdod", "nitrogen"]
SOIL_DEPTHS = {
    "split": ["0-5cm", "5-15cm", "15-30cm", "30-60cm"],
    "regex": ["0-5cm", "5-15cm", "15-30cm"],
}

# Satellite search radius (m), cloud limit (%), fixed window (end excluded).
RADIUS_M = 500.0
CLOUD_LIMIT = 20
RECENT_WINDOW = ("2020-01-01", "2023-12-31")
S2_FIRST_YEAR, L8_FIRST_YEAR = 2017, 2013

# Output band names by role for each sensor.
BANDS = {
    "S2": {"blue": "B2", "green": "B3", "red": "B4", "nir": "B8", "swir1": "B11", "swir2": "B12"},
    "L8": {"blue": "SR_B2", "green": "SR_B3", "red": "SR_B4", "nir": "SR_B5", "swir1": "SR_B6"},
    "L7": {"blue": "SR_B1", "green": "SR_B2", "red": "SR_B3", "nir": "SR_B4", "swir1": "SR_B5"},
}
INDICES = {
    "S2": ["NDVI", "EVI", "NDWI", "BSI", "ClayRatio", "IronOxide", "SAVI"],
    "L8": ["NDVI", "NDWI", "BSI", "IronOxide", "SAVI"],
    "L7": ["NDVI", "NDWI", "BSI", "IronOxide", "SAVI"],
}

# Days in a climate year, blend weights, analysis settings.
YEAR_DAYS = 365
BLEND_WEIGHTS = (0.35, 0.65)
HISTOGRAM_BINS = 60
DESCRIBE_FRACTIONS = [0.1, 0.25, 0.5, 0.75, 0.9]
PH_TARGETS = ["Al", "Ca", "Fe", "Mg", "Mn", "K"]
SCATTER_PAIRS = [
    ("C_organic", "N"),
    ("C_organic", "Al"),
    ("ph", "Ca"),
    ("ph", "Al"),
    ("ph", "Fe"),
    ("electrical_conductivity", "Na"),
]
BOX_TARGETS = ["Al", "Ca", "Fe", "Mg", "K", "N"]
