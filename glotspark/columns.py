"""Column names that every operator and model of this package agrees on."""

# The public column contract.
TEXT = "text"
FILTERED = "filteredText"
TOKENS = "tokenizedText"
NGRAMS = "ngrams"
FEATURES = "features"
LABEL = "label"
LABEL_INDEX = "labelIndex"
PREDICTION_INDEX = "predictionIndex"
PREDICTION = "prediction"
PROBABILITY = "probability"

ID = "id"
CREATED_AT = "created_at"

UNKNOWN = "unknown"
MIN_TEXT_LENGTH = 30
