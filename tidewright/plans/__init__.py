"""Compositions: staging loads, the validated layer, dependent datasets."""
