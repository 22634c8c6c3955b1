"""Word n-gram transition models built, stored, analysed and walked with Spark."""

from gramloom.plans.model import AlreadyTrained, TransitionModel
from gramloom.sources.corpus import load_corpus

__all__ = ["AlreadyTrained", "TransitionModel", "load_corpus"]
