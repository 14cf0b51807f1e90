"""Daily product-usage and revenue analytics as PySpark DataFrame operators."""

from daymark.config import Inputs, Vocabulary

__all__ = ["Inputs", "Vocabulary"]
