"""The registered queries; importing the modules registers them."""

from freshet.plans import bounded, conforming, feeds, ingesting, streams
from freshet.plans.registry import PLANS

__all__ = ["PLANS", "bounded", "conforming", "feeds", "ingesting", "streams"]
