"""Hullmark: a Spark-native engine for inventories of sunken vessels."""
