"""Schemas of the tables that the engine reads and writes."""

from __future__ import annotations

PHOTON = (
    "granule_id1 bigint, granule_id2 bigint, beam tinyint, longitude double, latitude double, h_ellipsoid float, h_geoid float, h_meantide float, "
    "class_code tinyint, conf_land tinyint, conf_land_ice tinyint, quality_ph tinyint, dist_x double, delta_time double"
)
CELLS = "tile_id string, i int, j int, value double"
GRID = "tile_id string, xleft double, ytop double, xres double, yres double, xsize int, ysize int, ndv double, epsg int"
CATALOGUE = "tile_id string, xmin double, ymin double, xmax double, ymax double, numphotons bigint, numphotons_canopy bigint, numphotons_ground bigint, is_populated boolean"
ATTRIBUTES = "value int, count bigint, institution string, resolution double"
