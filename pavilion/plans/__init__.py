"""Conforming, staging, marts, serving and the daily job."""
