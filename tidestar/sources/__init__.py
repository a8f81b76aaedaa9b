"""Inputs: change files, the sample feeds, synthetic feeds."""
