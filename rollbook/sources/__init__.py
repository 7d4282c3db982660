"""Readers for the kinds of files the reports start from."""
