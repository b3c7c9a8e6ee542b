"""Scans of Space Ranger style text outputs and result sinks."""
