"""DataFrame -> DataFrame steps; none of them runs a job except where it says so."""
