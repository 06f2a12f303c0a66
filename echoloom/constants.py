"""Names and values shared by all layers."""

from __future__ import annotations

from dataclasses import dataclass

# Label names, their codes and the reserved topic names.
NEGATIVE, NEUTRAL, POSITIVE, UNKNOWN = "Negative", "Neutral", "Positive", "Unknown"
LABELS = (NEGATIVE, NEUTRAL, POSITIVE)
LABEL_CODES = {NEGATIVE: 0, NEUTRAL: 1, POSITIVE: 2}
NOISE = -1
UNCATEGORIZED = "Uncategorized"
UNKNOWN_TOPIC = "Unknown Topic"

# Split, vectoriser and result lifetime settings.
TEST_SHARE = 0.2
SPLIT_SEED = 42
MAX_TERMS = 10_000
RESULT_TTL_SECONDS = 3600


@dataclass(frozen=True)
class Warehouse:
    """Where the layer tables live and how they are stored."""

    catalog: str | None = None
    prefix: str = ""
    file_format: str = "parquet"

    def schema(self, layer: str) -> str:
        name = f"`{self.prefix}{layer}`"
        return f"`{self.catalog}`.{name}" if self.catalog else name

    def table(self, layer: str, name: str) -> str:
        return f"{self.schema(layer)}.`{name}`"


BRONZE, SILVER, GOLD, ML = "bronze", "silver", "gold", "ml"
LAYERS = (BRONZE, SILVER, GOLD, ML)
LAYER_TABLES = {
    BRONZE: "bronze_reviews",
    SILVER: "silver_reviews",
    GOLD: "gold_reviews",
}
ML_FEATURES = "ml_features"
ML_TRAIN = "ml_train_data"
ML_TEST = "ml_test_data"
ML_PREDICTIONS = "ml_predictions"
ML_RUNS = "ml_runs"
ML_MODELS = "ml_models"
