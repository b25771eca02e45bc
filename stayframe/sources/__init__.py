"""Inputs: driver-table loader, the clinical-table recipe, stored intermediates."""
