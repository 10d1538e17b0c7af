"""Behaviour-graph embeddings and audience expansion on Spark DataFrames."""

from walkvec.config import Config

__all__ = ["Config"]
