"""Purchase-prediction features, segments, scores and selections on Spark DataFrames."""

from shoplens.session import HandOver, build_session, shared_folder, tune
from shoplens.settings import Calendar

__all__ = ["Calendar", "HandOver", "build_session", "shared_folder", "tune"]
