"""Intermediate tables in the folder that all executors share (the core's)."""

from __future__ import annotations

from ..session import scratch_path, scratch_scope, written, written_with

__all__ = ["scratch_path", "scratch_scope", "written", "written_with"]
