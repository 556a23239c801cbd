"""Readers of event files, requests, notifications and payloads."""
