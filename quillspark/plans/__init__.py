"""Registered analyses over the driver tables (``queries``) and their SQL
counterparts (``oracle``)."""
