"""Vault loads, golden records, marts and job recipes built from operators."""
