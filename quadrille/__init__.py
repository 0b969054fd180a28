"""Quadrille: zonal statistics and series of gridded, multi-sensor observations as Spark plans."""
