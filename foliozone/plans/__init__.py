"""Date-range plans and the two stages built on them."""
