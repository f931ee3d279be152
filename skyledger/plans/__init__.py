"""Whole jobs, and the registered queries with the inputs they run on."""
