"""textforge: Spark-native article ingestion, cleaning and enrichment."""

from textforge.config import CleaningConfig, PipelineConfig

__all__ = ["CleaningConfig", "PipelineConfig"]
__version__ = "0.1.0"
