"""Where the tests read their tables."""

SMALL = "/root/testdata/sf0.001"
