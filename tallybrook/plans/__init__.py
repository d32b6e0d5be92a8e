"""Whole jobs: operators put together over given inputs."""
