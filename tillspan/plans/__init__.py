"""How the operators run: session settings, joins that survive skew, prefix sums, lineage cuts."""
