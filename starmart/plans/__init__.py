"""Reports over the star tables, and the whole job."""
