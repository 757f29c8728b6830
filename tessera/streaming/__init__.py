"""Incremental reading of dumps."""
