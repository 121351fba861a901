"""pathweave: a Spark-native engine for street-network, place and corpus analytics."""
