"""Readers for pipeline layers, configs and derived test layers."""
