"""siltstone: layered lakehouse operators and jobs written with the Spark DataFrame API."""

from siltstone.spec import LOCATIONS, LayerSpec

__all__ = ["LOCATIONS", "LayerSpec"]
