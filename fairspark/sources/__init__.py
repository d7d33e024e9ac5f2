from .partitioning import spread
from .points import (GROUP_A, GROUP_B, group_counts, load_points, parse_points,
                     persist_points, points_from, points_from_array, read_lines)
from .diverted import DivertedPoints, read_points_diverted
from .numbering import numbered
from .synth import deal_points, synth_points, synth_points_of
from .text import lines_from, read_text_lines

__all__ = ["GROUP_A", "GROUP_B", "group_counts", "load_points", "parse_points",
           "persist_points", "points_from", "points_from_array", "read_lines", "synth_points", "synth_points_of",
           "lines_from", "DivertedPoints", "read_points_diverted", "numbered", "deal_points", "read_text_lines", "spread"]
