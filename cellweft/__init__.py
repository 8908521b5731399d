"""cellweft: Spark operators over multiplexed-imaging cell tables."""

from cellweft.settings import Options

__all__ = ["Options"]
__version__ = "0.1.0"
