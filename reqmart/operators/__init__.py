"""Generic DataFrame operators.

None of them collects a group into one task: what would be a window over a whole partition is an
aggregate (combined on the map side) joined back to the rows, and such a join can be split when one
key holds a large share of them.
"""
