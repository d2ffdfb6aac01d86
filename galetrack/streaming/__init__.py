"""Fixes as they arrive: labels, landfalls and running extremes."""
