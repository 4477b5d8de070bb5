"""Measurements beside the headline benchmark."""
