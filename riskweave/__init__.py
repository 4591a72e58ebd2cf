"""riskweave: grid x quarter panel analytics expressed as Spark DataFrame plans."""
