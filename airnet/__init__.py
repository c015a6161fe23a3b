"""airnet: PySpark DataFrame operators for sensor series and transport-network analytics."""

__version__ = "0.1.0"
