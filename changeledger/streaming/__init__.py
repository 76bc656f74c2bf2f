"""Jobs on live inputs."""
