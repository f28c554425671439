"""Spark analytics operators: plain functions from DataFrame to DataFrame."""
