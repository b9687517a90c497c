"""Streaming analytics over append-only, strictly typed sources, on Spark."""

from freshet.errors import FreshetError
from freshet.operators.conform import conform
from freshet.session import build_session
from freshet.workspace import CheckpointConfig, Config, Workspace, open_workspace

__all__ = ["CheckpointConfig", "Config", "FreshetError", "Workspace", "build_session", "conform", "open_workspace"]
