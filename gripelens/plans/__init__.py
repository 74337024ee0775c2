"""Platform presets and the reports composed from operators."""
