"""Multi-horizon AQI forecast with MLlib: dataset (ML1-ML4), model (ML5-ML8), scoring (ML9-ML14)."""
