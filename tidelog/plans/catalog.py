"""All registered queries."""

from __future__ import annotations

from tidelog.plans import attachments, edges, feed, queue, reads, status  # noqa: F401
from tidelog.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
