"""Membership inversion on Spark: many category -> employees datasets become one
employee -> categories dataset, profiled and delivered."""
