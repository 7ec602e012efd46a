"""Anchoring pressure on seagrass meadows from satellite vessel detections, as PySpark DataFrame operations."""

from .config import Params

__all__ = ["Params"]
