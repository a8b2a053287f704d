"""Stages and registered queries."""
